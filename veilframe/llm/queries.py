"""The registered queries of the operators and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import classifier, decontaminate, licenses, line_dedup, mixing, ngram_join, phrases, preferences, secret_ledger, simhash, spotsigs, suffix_dedup, token_alignment
from veilframe.llm.shared import table
from veilframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classifier.classified(*classifier.co_train(docs, table(spark, sf_dir, "labels"), ["doc_id"]))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=("n_lines", "n_deleted"), min_words=line_dedup.MIN_WORDS)


ORACLES["op2_line_dedup"] = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, i, n, ls[i:i + n - 1] AS run FROM l, (VALUES (1), (2), (3)) AS s(n), unnest(range(1, len(ls) - n + 2)) AS u(i)),
r AS (SELECT * FROM w WHERE n = 3 OR len(regexp_extract_all(array_to_string(run, chr(10)), '[^\x20\x09-\x0D]+')) > 50),
f AS (SELECT doc_id, i, n, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS copy FROM r),
d AS (SELECT DISTINCT doc_id, i + k AS i FROM f, (VALUES (0), (1), (2)) AS s(k) WHERE copy > 1 AND k < n),
g AS (SELECT doc_id, list(i) AS gone FROM d GROUP BY doc_id)
SELECT l.doc_id,
       CASE WHEN gone IS NULL THEN text
            ELSE array_to_string(list_filter(ls, lambda x, n: NOT list_contains(gone, n)), chr(10)) END AS text,
       coalesce(len(ls), 0)::BIGINT AS n_lines,
       coalesce(len(gone), 0)::BIGINT AS n_deleted
FROM l LEFT JOIN g USING (doc_id)
"""


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


MIX_CTES = """
r AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS hash
      FROM {table}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
             (2 * source_size)::DOUBLE AS cap FROM s),
m AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS multiple,
             cap / weight AS ratio
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
lv AS (SELECT arg_min(multiple, (ratio, source IS NULL, source)) AS level FROM m WHERE multiple * weight <= cap),
t AS (SELECT source, source_size, least(cap, level * weight) AS target,
             CASE WHEN source_size > 0 THEN floor(least(cap, level * weight) / source_size)::BIGINT ELSE 0 END AS whole
      FROM m, lv),
h AS (SELECT source, hash, sum(size) AS words FROM r WHERE size > 0 GROUP BY source, hash),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY hash) AS until FROM h),
x AS (SELECT c.source, c.hash, until, words, target - whole * source_size AS rest
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
again AS (SELECT source, hash FROM x
          WHERE until <= rest OR until - words <= rest AND words <= 2 * (rest - (until - words)))
"""
ORACLES["op4_source_mix"] = f"""
WITH {MIX_CTES.format(table="documents")}
SELECT r.doc_id, r.size, t.source_size, t.target,
       (r.size * (t.whole + CASE WHEN a.hash IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
LEFT JOIN again a ON r.source IS NOT DISTINCT FROM a.source AND r.hash = a.hash
"""


@query
def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger = secret_ledger.SecretLedger(spark, scratch_path(spark, "ledger"))
    ledger.scan(versions)
    spans = secret_ledger.digest(F.col("spans"))
    counts = [f"n_{r.kind}" for r in secret_ledger.RULES]
    return ledger.report(versions).select(F.col("path").alias("doc_id"), *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ASSIGN = _sql(secret_ledger.RULES[0].pattern)
ORACLES["op7_secret_ledger"] = f"""
WITH r(kind, nth, pattern, grp, least) AS (
    VALUES ('assign', 0, {ASSIGN}, 2, 6), ('access', 1, 'AKIA[A-Z0-9]+', 0, 20), ('hex', 2, '[0-9a-f]+', 0, 24)),
t AS (SELECT doc_id, kind, nth, pattern, grp, least, string_split_regex(coalesce(text, ''), pattern) AS gaps,
             regexp_extract_all(coalesce(text, ''), pattern) AS hits FROM documents, r),
m AS (SELECT doc_id, kind, nth, least, hits[i] AS hit,
             CASE WHEN grp = 0 THEN hits[i] ELSE regexp_extract(hits[i], {ASSIGN}, 2) END AS counted,
             (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
      FROM t, unnest(range(1, len(hits) + 1)) AS u(i)),
k AS (SELECT *, kind || ':' || start || ':' || (start + length(hit)) AS span FROM m WHERE length(counted) >= least),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, nth) AS spans FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""


@query
def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preference_rows(*preferences.swapped_answers(table(spark, sf_dir, "conversations")))


ORACLES["op9_preference_pairs"] = """
WITH l AS (SELECT conv_id, max((turn, text)) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
s AS (SELECT conv_id, last[1] AS t, coalesce(lead(last[2]) OVER (ORDER BY conv_id), '') AS other FROM l),
b AS (SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM conversations
      UNION ALL
      SELECT c.conv_id, 'rejected', turn, role, CASE WHEN role = 'assistant' AND turn = s.t THEN other ELSE text END
      FROM conversations c LEFT JOIN s USING (conv_id)),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS nth FROM b),
d AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id,
             coalesce(min(coalesce(c.nth, r.nth)) FILTER (c.nth IS NULL OR r.nth IS NULL OR c.role IS DISTINCT FROM r.role
                                                          OR c.text IS DISTINCT FROM r.text), max(c.nth) + 1) AS common
      FROM (SELECT * FROM n WHERE side = 'chosen') c FULL JOIN (SELECT * FROM n WHERE side = 'rejected') r USING (pair_id, nth)
      GROUP BY 1),
p AS (SELECT n.*, CASE WHEN nth < common THEN 'prompt' ELSE side END AS part, common,
             '<|im_start|>' || coalesce(role, '') || chr(10) AS head,
             '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered
      FROM n JOIN d USING (pair_id)),
o AS (SELECT *, (sum(length(rendered)) OVER (PARTITION BY pair_id, side ORDER BY nth))::BIGINT AS "end" FROM p)
SELECT pair_id, part, nth, role, rendered, "end" - length(rendered) AS start, "end",
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN "end" - length(rendered) + length(head) END AS loss_start,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN "end" END AS loss_end
FROM o WHERE side = 'chosen' OR nth >= common
"""


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op5_license_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])


@query
def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.against_edits(table(spark, sf_dir, "documents"))


ORACLES["op6_spotsigs"] = spotsigs.SQL


@query
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


@query
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLES["op12_collocations"] = phrases.SQL


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(table(spark, sf_dir, "documents").select("doc_id", "text"))

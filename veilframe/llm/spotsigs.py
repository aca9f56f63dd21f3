"""Document fingerprints by spot signatures.

A signature is an anchor (a very common word) with the chain of the next ``CHAIN`` content words
after it; common words in between are skipped.  The fingerprint is the set of the signatures' hashes,
and two sets are as alike as their Jaccard coefficient.  A text with fewer than one spot for every ``SPARSE`` words
(lists, code, other languages, texts of a few words) is hardly covered by its spots; there each word with the next
``CHAIN`` is a signature, too, so that every fingerprint stands for its whole text.

``near_pairs`` finds alike sets.  Sets are dealt to partitions by length so that those long
enough to be alike lie in one partition or the next; inside they meet on their rarest
signatures only, and are compared in full after a look at their lengths.

Words are runs of ASCII letters, digits and all other letters; A-Z is lower-cased.

Defined cases: a null text is empty; a text without words has an empty fingerprint, which is 1
alike to another empty one and 0 to all else; the next document goes by id (null last), then by
a hash of the text, and of equal rows one comes after the other; a table of one row is its own
next; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.shared import partitions, stored

#: Content words of a chain, and words after an anchor that are searched for them.
CHAIN, LOOK = 2, 8
# The anchors, then the other common words that a chain skips (English, French, German, Spanish).
ANCHORS = (
    "the a an is was are be le la les un une est der die das ein eine ist el los una es"
).split()
COMMON = ANCHORS + (
    "of and to in that it for on with as by this at from he or not have has his they you we "
    "de des et en que du au dans pour qui sur par il elle avec ne pas "
    "und zu den von mit sich auf dem im nicht auch als für er sie "
    "y se del que por con no su lo las al para como"
).split()
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words for each spot, from which on all words of a text are taken.
SPARSE = 16
#: Two sets are alike from this coefficient on.
ALIKE = 0.8


def spots_of(words: Column) -> Column:
    """Each anchor of a text's words with its chain, in order."""

    def chain(word: Column, nth: Column) -> Column:
        content = F.filter(F.slice(words, nth + 2, F.lit(LOOK)), lambda w: ~w.isin(COMMON))
        spot = F.concat(F.array(word), F.slice(content, 1, CHAIN))
        return F.when(word.isin(ANCHORS) & (F.size(spot) == CHAIN + 1), F.array_join(spot, " "))

    return F.array_compact(F.transform(words, chain))


def signatures(spots: Column, words: Column) -> Column:
    """The distinct signatures' hashes (8 hex digits), sorted."""
    every = F.transform(words, lambda _, nth: F.array_join(F.slice(words, nth + 1, F.lit(CHAIN + 1)), " "))
    taken = F.when(F.size(spots) * SPARSE < F.size(words), F.concat(spots, every)).otherwise(spots)
    return F.sort_array(F.array_distinct(F.transform(taken, lambda s: F.substring(F.md5(s), 1, 8))))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the fingerprint of ``text`` as hashes joined by commas."""
    rows = df.withColumn(out, words_of(F.col(text)))
    rows = rows.withColumn("spots_", spots_of(F.col(out)))  # used twice, so computed in a step of its own
    return rows.withColumn(out, F.array_join(signatures(F.col("spots_"), F.col(out)), ",")).drop("spots_")


def _set(fingerprint: Column) -> Column:
    return F.when(fingerprint == "", F.array().cast("array<string>")).otherwise(F.split(fingerprint, ","))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - both
    return F.when(total == 0, 1.0).otherwise(both / total)


def _ranges(rows: DataFrame, n: int) -> Column:
    """Numbers that grow with the order of ``rows`` (doc_id, null last, then tie) and hold about one n-th of them each.

    Bounds are percentiles of the ids.  An id that is several bounds at once, or null, holds more than
    a share; its rows are dealt on by their tie, a hash, whose range is cut evenly.
    """
    shares = F.array(*[F.lit(k / n) for k in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    found = rows.agg(F.percentile_approx("doc_id", shares).alias("b"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.count("*").alias("n")).first()
    bounds = Counter(found["b"] or [])
    distinct = sorted(bounds)
    inside = F.size(F.filter(F.array(*[F.lit(b) for b in distinct]).cast("array<long>"), lambda b: b < F.col("doc_id")))
    base = F.coalesce(F.when(F.col("doc_id").isNotNull(), inside), F.lit(len(distinct) + 1))
    parts = F.lit(1)
    for hot in (b for b in distinct if bounds[b] > 1):
        parts = F.when(F.col("doc_id") == hot, F.lit(bounds[hot] + 1)).otherwise(parts)
    parts = F.when(F.col("doc_id").isNull(), F.lit(1 + n * found["nulls"] // max(found["n"], 1))).otherwise(parts)
    part = F.least(F.floor((F.col("tie") / F.lit(2.0**64) + 0.5) * parts), parts - 1)
    return base.cast("long") * (n + 2) + part


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp of ``docs`` and next_text, next_fp of the next document by id; after the last comes the first.

    Documents are dealt by ranges of ids; each range gets a copy of the first document of the
    range after it, so one shuffle brings neighbours together.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("range", _ranges(rows, partitions(docs.sparkSession)))

    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tie")
    firsts = rows.groupBy("range").agg(F.min(order).alias("first"))  # a row for each range
    by_range = Window.orderBy("range")
    all_rows = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("range").over(by_range), F.last("range").over(all_rows))
    firsts = stored(firsts.select("first.doc_id", "first.tie", before.alias("to")), "firsts").toDF("d", "t", "to")
    copies = rows.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")))
    copies = copies.groupBy("doc_id", "tie", F.col("to").alias("range")).agg(F.first("text").alias("text"))
    both = rows.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))
    both = fingerprint(both, "text", "fp")
    following = Window.partitionBy("range").orderBy("copy", F.col("doc_id").asc_nulls_last(), "tie")
    both = both.withColumn("next", F.lead(F.struct("text", "fp")).over(following)).where(~F.col("copy"))
    return both.select("doc_id", "text", "fp", F.col("next.text").alias("next_text"), F.col("next.fp").alias("next_fp"))


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(following, half))


def against_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures."""
    rows = with_next(docs).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", "next_fp", "edited")
    rows = fingerprint(rows, "edited", "edited_fp")
    own = _set(F.col("fp"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness(own, _set(F.col("edited_fp"))).alias("near_edited"),
        likeness(own, _set(F.col("next_fp"))).alias("near_next"),
        F.size(own).cast("long").alias("n_signatures"),
    )


def length_bounds(longest: int, alike: float = ALIKE) -> list[int]:
    """First lengths of the partitions: a set can only be alike to sets of its own or a neighbouring partition."""
    bounds = [1]
    while bounds[-1] <= longest:
        bounds.append(int(bounds[-1] / alike) + 1)
    return bounds


def near_pairs(docs: DataFrame, alike: float = ALIKE) -> DataFrame:
    """a, b, likeness: fingerprints of ``docs`` (a < b, each distinct one once) that are ``alike`` or more.

    Equal fingerprints are one; join them back to the documents for membership.
    """
    sets = stored(
        fingerprint(docs.select(F.coalesce("text", F.lit("")).alias("text")), "text", "fp").where("fp <> ''").select("fp").distinct(), "sets"
    )
    sets = sets.select(F.xxhash64("fp").alias("id"), "fp", _set(F.col("fp")).alias("s"))
    sets = stored(sets.withColumn("n", F.size("s")), "sets")
    spots = sets.select("id", "n", F.explode("s").alias("sig"))
    common = spots.groupBy("sig").agg(F.count("*").alias("df"))
    ranked = spots.join(common, "sig").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("r"))
    keep = F.col("n") - F.ceil(F.col("n") * alike) + 1  # two alike sets share one of their rarest
    rare = ranked.select("id", "n", F.explode(F.slice("r", F.lit(1), keep.cast("int"))).alias("x")).select("id", "n", "x.sig")
    longest = sets.agg(F.max("n")).first()[0] or 0
    bounds = F.array(*[F.lit(b) for b in length_bounds(longest, alike)])
    rare = rare.withColumn("part", F.size(F.filter(bounds, lambda b: b <= F.col("n"))))
    probe = rare.select(F.col("id").alias("x"), F.col("n").alias("m"), "sig", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    longer = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("x") < F.col("id")))
    met = probe.join(rare, ["sig", "part"]).where(longer & (F.col("m") >= F.col("n") * alike)).select("x", "id").distinct()
    left, right = sets.select(F.col("id").alias("x"), F.col("fp").alias("p"), F.col("s").alias("u")), sets.select("id", "fp", "s")
    pairs = met.join(left, "x").join(right, "id").withColumn("likeness", likeness(F.col("u"), F.col("s"))).where(F.col("likeness") >= alike)
    return pairs.select(F.least("p", "fp").alias("a"), F.greatest("p", "fp").alias("b"), "likeness")


def sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _sql_fingerprint(text: str) -> str:
    """DuckDB SQL for the fingerprint of a text."""
    words = f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{WORD}')"
    chain = f"[w[i]] || list_filter(w[i + 1:i + {LOOK}], lambda x: NOT list_contains({sql_list(COMMON)}, x))[1:{CHAIN}]"
    spots = f"list_filter(list_transform(range(1, len(w) + 1), lambda i: {chain}), lambda s: len(s) = {CHAIN + 1} AND list_contains({sql_list(ANCHORS)}, s[1]))"
    spots = f"list_transform({spots}, lambda s: array_to_string(s, ' '))"
    every = f"list_transform(range(1, len(w) + 1), lambda i: array_to_string(w[i:i + {CHAIN}], ' '))"
    taken = f"CASE WHEN len(s) * {SPARSE} < len(w) THEN s || {every} ELSE s END"
    hashes = f"list_sort(list_distinct(list_transform({taken}, lambda x: substr(md5(x), 1, 8))))"
    return f"(SELECT {hashes} FROM (SELECT w, {spots} AS s FROM (SELECT {words} AS w)))"


def _sql_likeness(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE {both}::DOUBLE / (len({a}) + len({b}) - {both}) END"


SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER o, first_value(text) OVER o) AS following FROM t WINDOW o AS (ORDER BY doc_id NULLS LAST)),
e AS (SELECT *, left(text, length(text) - length(text) // 2) || left(following, length(text) // 2) AS edited FROM n),
f AS (SELECT *, {_sql_fingerprint("text")} AS fp, {_sql_fingerprint("edited")} AS ep, {_sql_fingerprint("following")} AS np FROM e)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(fp, ',') AS fingerprint,
       array_to_string(ep, ',') AS edited_fingerprint, {_sql_likeness("fp", "ep")} AS near_edited,
       {_sql_likeness("fp", "np")} AS near_next, len(fp)::BIGINT AS n_signatures
FROM f
"""

"""Every query of the engine by name: a Spark plan and, where SQL can say it, an oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions import scalars
from veilframe.functions import word_lists as W
from veilframe.functions.register import register_redact, register_redact_core, register_redact_table
from veilframe.functions.rules import CORE, FULL
from veilframe.operators import conversations, dictionaries, distinct_counts, ordered, queries, scoring
from veilframe.operators.lexicon import NameLexicon
from veilframe.operators.redaction import redact, redact_core, redact_names, redact_patterns
from veilframe.plans import acceptance, oracles, templates
from veilframe.session import PAGES, SENTENCES, scratch_path, spread
from veilframe.sources import corpus, files, words
from veilframe.streaming import redact_stream as stream

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parquet_queries(spark: SparkSession, sf_dir: str, sql: str | None = None) -> queries.ParquetQueries:
    """The tables of a directory; given a query, only those it names."""
    names = [t for t in TABLES if sql is None or re.search(rf"\b{t}\b", sql)]
    return queries.ParquetQueries(spark, {name: f"{sf_dir}/{name}.parquet" for name in names})


# --- SQL over Parquet, catalog, results ---------------------------------------


def run_sql(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = acceptance.SPARK[name]
    return parquet_queries(spark, sf_dir, sql).query(sql)


def sql_max_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2 ORDER BY n DESC, event_type, user_id"
    return parquet_queries(spark, sf_dir, sql).query(sql + "; ", max_rows=20)


def records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = """
        SELECT c_custkey, c_name, c_acctbal, n_orders, cast(c_custkey % 100 AS decimal(12, 2)) AS cents, last_day,
               named_struct('key', c_nationkey, 'tags', array(c_mktsegment, null)) AS nested
        FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, cast(max(o_orderdate) AS date) AS last_day
                   FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) o
          ON o_custkey = c_custkey"""
    return queries.records(parquet_queries(spark, sf_dir, sql).query(sql))


def table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many files: rows by directory, and whether the scan's file sizes and dates are those of the listing."""
    path = scratch_path(spark, "lineitem")
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_orderkey", "l_returnflag")
    lines.write.partitionBy("l_returnflag", "l_linenumber").parquet(path)
    file = F.regexp_extract("name", "[^=/]+=[^/]+/[^=/]+=[^/]+/[^/]+$", 0).alias("file")
    scanned = files.table_files(spark.read.parquet(path), paths=True).select(file, "size", "modified", "n_rows")
    listed = files.file_facts(spark, f"{path}/*/*").select(file, F.col("size").alias("s"), F.col("modified").alias("m"))
    flag, number = (F.regexp_extract("file", f"{column}=([^/]+)", 1) for column in ("l_returnflag", "l_linenumber"))
    both = scanned.join(listed, "file", "left")
    same = F.col("s").eqNullSafe(F.col("size")) & F.col("m").eqNullSafe(F.col("modified"))
    rows = both.select(flag.alias("l_returnflag"), number.cast("int").alias("l_linenumber"), "n_rows", same.alias("same"))
    return rows.groupBy("l_returnflag", "l_linenumber").agg(
        F.sum("n_rows").alias("n_rows"), F.bool_and("same").alias("agrees")
    )


# --- what a plain window, join or DISTINCT would do in one task or by copying rows ---


def cheaper_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many parts of its brand are cheaper than each part, and the sum of their prices."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_retailprice").cast("decimal(15,2)").alias("price"))
    below = ordered.sums_below(parts, parts, ["p_brand"], "price", {"n_cheaper": F.lit(1), "sum_cheaper": F.col("price")})
    joined = parts.join(below.toDF("b", "p", "n_cheaper", "sum_cheaper"), F.col("p_brand").eqNullSafe(F.col("b")) & F.col("price").eqNullSafe(F.col("p")))
    return joined.select("p_partkey", "n_cheaper", F.col("sum_cheaper").cast("double").alias("sum_cheaper"))


def sliding_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and value of each user's events in the seven days up to each event."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.col("value").cast("decimal(15,2)").alias("amount"))
    sums = ordered.sliding_sums(events, ["user_id"], "ts", "7 DAYS", {"n_week": F.lit(1), "value_week": F.col("amount")})
    return sums.select("event_id", "n_week", F.col("value_week").cast("double").alias("value_week"))


def running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's place among all events, and how many purchases there were up to it."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("event_type") == "purchase").cast("int").alias("bought"))
    return ordered.running_sums(events, [], ["ts", "event_id"], {"place": F.lit(1), "purchases": F.col("bought")}).select("event_id", "place", "purchases")


def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users by event type and day, by type, and of all events."""
    events = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    return distinct_counts.rollup_distinct(events, ["event_type", "day"], "user_id", "n_users")


# --- redaction ----------------------------------------------------------------


def orders_texts(spark: SparkSession, sf_dir: str, cases: list[tuple[str, str]], target: bool = False) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders"), SENTENCES).selectExpr("o_orderkey AS k", "o_custkey AS c")
    columns = ["k AS o_orderkey", f"{templates.case_sql(cases, 0)} AS text"]
    if target:
        columns.append(f"{templates.case_sql(cases, 1)} AS target")
    return orders.selectExpr(*columns)


def name_lexicon(spark: SparkSession, sf_dir: str, **limits: int) -> NameLexicon:
    keys = table(spark, sf_dir, "orders").selectExpr("o_custkey AS c").distinct()
    word = F.expr(templates.WORD).alias("word")
    role = F.col("c") % 5
    flags = {"is_given": (0, 2, 4), "is_surname": (1, 2, 3), "is_ambiguous": (3,), "is_stop": (4,)}
    return NameLexicon(keys.select(word, *[role.isin(*roles).alias(f) for f, roles in flags.items()]), **limits)


def redact_family(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    texts = orders_texts(spark, sf_dir, templates.FAMILIES[family])
    return texts.select("o_orderkey", redact_patterns(F.col("text")).alias("redacted"))


def redact_table(spark: SparkSession, sf_dir: str, name: str, key: list[str], column: str, profile: str) -> DataFrame:
    texts = spread(table(spark, sf_dir, name).select(*key, column))
    return texts.select(*key, redact_patterns(F.col(column), profile).alias("redacted"))


def changed_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("lang", "text"))
    redacted = documents.select("lang", (redact_core(F.col("text")) != F.col("text")).alias("changed"))
    return redacted.groupBy("lang").agg(F.count_if("changed").alias("n_changed"), F.count("*").alias("n_docs"))


def profile_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the two profiles differ: dates without a year."""
    texts = orders_texts(spark, sf_dir, templates.FAMILIES["DATE"])
    both = redact(redact(texts, "text", output="core", profile=CORE), "text", output="full")
    return both.filter(F.col("core") != F.col("full")).select("o_orderkey", "core", "full")


def redact_by_name_rules(spark: SparkSession, sf_dir: str, group: str, **limits: int) -> DataFrame:
    texts = orders_texts(spark, sf_dir, templates.NAMES[group])
    return redact_names(texts, "text", name_lexicon(spark, sf_dir, **limits)).select("o_orderkey", "redacted")


ALL_CASES = [case for cases in (*templates.FAMILIES.values(), *templates.NAMES.values()) for case in cases]


def redact_full(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    texts = orders_texts(spark, sf_dir, ALL_CASES)
    return redact(texts, "text", name_lexicon(spark, sf_dir, **limits)).select("o_orderkey", "redacted")


def redact_full_sql(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    name = "redact_joined" if limits else "redact"
    register_redact(spark, name_lexicon(spark, sf_dir, **limits), name)
    return orders_texts(spark, sf_dir, ALL_CASES).selectExpr("o_orderkey", f"{name}(text) AS redacted")


def redact_full_table(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    """All rules as a table function, over a table that is known to the session by name."""
    orders_texts(spark, sf_dir, ALL_CASES).createOrReplaceTempView("veil_order_texts")
    name = "redact_orders_joined" if limits else "redact_orders"
    register_redact_table(spark, name_lexicon(spark, sf_dir, **limits), "veil_order_texts", "text", name)
    return spark.sql(f"SELECT o_orderkey, redacted FROM {name}()")


def redact_core_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_redact_core(spark)
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return documents.selectExpr("doc_id", "redact_core(text) AS redacted")


def documents_with_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name rules over the documents with a name put before, between and after their lines; the rest must stay."""
    words = [("Zyxanna", True, False), ("Zyxschmidt", False, True), ("Zyxrose", True, False)]
    names = spark.createDataFrame(words, "word string, is_given boolean, is_surname boolean")
    lexicon = NameLexicon(names.selectExpr("*", "word = 'Zyxrose' AS is_ambiguous", "false AS is_stop"))
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), PAGES)
    return redact_names(documents.selectExpr("doc_id", f"{placed_names(0)} AS text"), "text", lexicon).drop("text")


def documents_with_own_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over the documents, with a dictionary made from their own words; SQL can't express it."""
    documents = table(spark, sf_dir, "documents")
    lexicon = NameLexicon(document_words(documents))
    result = redact(spread(documents.select("doc_id", "text"), PAGES), "text", lexicon)
    tokens = F.regexp_extract_all("redacted", F.lit(r"\[(GIVENNAME|LASTNAME|TITLE)[0-9]*\]"), F.lit(1))
    return result.select(
        "doc_id",
        F.size(F.filter(tokens, lambda t: t == "GIVENNAME")).alias("n_given"),
        F.size(F.filter(tokens, lambda t: t == "LASTNAME")).alias("n_last"),
        F.length("redacted").alias("length"),
    )


PLACED = (
    ("als Herr Zyxschmidt kam. ", "als [TITLE] [LASTNAME1] kam. "),
    ("\nbald\nViele Grüße,\nZyxanna Zyxschmidt\n", "\nbald\nViele Grüße,\n[GIVENNAME1] [LASTNAME1]\n"),
    (
        " wie Zyxanna von Zyxschmidt sagte, nicht Zyxrose allein; Vorname: Zyxrose",
        " wie [GIVENNAME1] von [LASTNAME1] sagte, nicht Zyxrose allein; Vorname: [GIVENNAME1]",
    ),
)


def placed_names(member: int) -> str:
    """SQL for ``text`` with the placed names (member 0) or with what they must become (member 1)."""
    before, between, after = (case[member] for case in PLACED)
    return f"'{before}' || replace(text, chr(10), '{between}') || '{after}'"


def document_words(documents: DataFrame) -> DataFrame:
    """A dictionary of the capitalised words of the documents, its flags set by word length."""
    found = documents.select(F.explode(F.regexp_extract_all("text", F.lit(r"(\p{Lu}\p{Ll}+)"), F.lit(1))).alias("word"))
    size = F.length("word")
    return found.distinct().select(
        "word",
        (size % 3 != 1).alias("is_given"),
        (size % 3 != 0).alias("is_surname"),
        (size % 4 == 0).alias("is_ambiguous"),
        (size <= 3).alias("is_stop"),
    )


# --- corpus and scoring -------------------------------------------------------

PHONE = templates.FAMILIES["PHONE"]


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs; every tenth target is wrong on purpose."""
    pairs = orders_texts(spark, sf_dir, PHONE, target=True)
    target = F.when(F.col("o_orderkey") % 10 == 0, F.concat("target", F.lit(" ü"))).otherwise(F.col("target"))
    return pairs.select(
        F.col("text").alias("source_text"), target.alias("target_text"), F.col("o_orderkey").alias("row_id")
    )


def flagged_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = raw_corpus(spark, sf_dir).select("row_id", *[f"{c}_text" for c in ("source", "target")])
    # no target: neither a match nor to be lost
    target = F.when(F.col("row_id") % 11 != 0, F.col("target_text"))
    named = pairs.select("row_id", F.col("source_text").alias("source"), target.alias("target"))
    return scoring.flag_matches(redact(named, "source"))


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(flagged_pairs(spark, sf_dir))


def mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.mismatches(flagged_pairs(spark, sf_dir), "row_id")


def scored_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mismatches with the score of the run that found them."""
    counts, rows = scoring.score_and_mismatches(flagged_pairs(spark, sf_dir), scratch_path(spark, "mismatches"), "row_id")
    return rows.select("row_id", "redacted", *[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw corpus out as JSON lines, in again, projected, out and in again."""
    raw, projected = scratch_path(spark, "raw"), scratch_path(spark, "pairs")
    corpus.write_json_lines(raw_corpus(spark, sf_dir), raw)
    corpus.write_json_lines(scoring.project_pairs(corpus.read_raw_corpus(spark, raw)), projected)
    return corpus.read_pairs(spark, projected)


def nth_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.nth_record(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id", 5)


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw corpus whose lines differ in their keys, and nest, written as JSON lines and read with all keys."""
    path = scratch_path(spark, "records")
    lines = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("source_text"),
        F.when(F.col("o_orderkey") % 3 == 0, F.struct(F.col("o_custkey").alias("by"), F.array("o_orderstatus", F.lit("ü")).alias("tags"))).alias("meta"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(True)).alias("it's checked"),
    )
    lines.select(F.to_json(F.struct("*")).alias("value")).write.text(path)  # nulls are left out
    return corpus.read_records(spark, path)


def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = mixed_records(spark, sf_dir).withColumn("row_id", corpus.field("row_id", kind="bigint"))
    return corpus.record_fields(records, "row_id").drop("pos")


def record_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = corpus.field("meta", "tags", 0).alias("first_tag")
    return mixed_records(spark, sf_dir).select(corpus.field("row_id", kind="bigint").alias("row_id"), corpus.field("meta").alias("meta"), tags)


def nth_record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.nth_record_fields(mixed_records(spark, sf_dir), "row_id", 30)


# --- dictionaries -------------------------------------------------------------


# What a customer is called: hyphen, inner capital after a prefix or not, apostrophe, a known name that is a word too.
LABEL = """CASE c_custkey % 13 WHEN 1 THEN {plain} || '-K' || {word} WHEN 2 THEN 'McK' || {word}
               WHEN 3 THEN {plain} || '’a' WHEN 4 THEN {plain} || 'B' WHEN 5 THEN 'Rose' ELSE {plain} END"""


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A knowledge base made from the keys of parts and customers."""
    letters = "translate(lpad(cast({0} AS string), 9, '0'), '0123456789', 'abdefgiklm')"
    word = letters.format("c_custkey div 3")
    plain = f"if(c_custkey % 7 = 0, 'x', 'K') || {word}"
    label = F.expr(LABEL.format(plain=plain, word=word))
    customer = table(spark, sf_dir, "customer").select("c_custkey", label.alias("label")).selectExpr(
        "concat('C', c_custkey) AS id",
        "element_at(array('Q202444', 'Q101352', 'Q515', 'Q5'), cast(c_custkey % 4 AS int) + 1) AS class",
        "label",
        "if(c_custkey % 11 = 0, 'ru', 'de') AS lang",
    )
    part = table(spark, sf_dir, "part").selectExpr(
        "concat('L', p_partkey) AS id",
        "if(p_partkey % 5 = 0, 'Q147276', 'Q1084') AS category",
        "if(p_partkey % 3 = 0, 'Q1860', if(p_partkey % 3 = 1, 'Q188', 'Q150')) AS language",
        f"concat('k', {letters.format('p_partkey')}) AS form",
    )
    facts = [
        customer.selectExpr("id AS s", "'P31' AS p", "class AS o", "cast(null AS string) AS lang"),
        customer.selectExpr("id", "'label'", "label", "lang"),
        part.selectExpr("id", "'language'", "language", "null"),
        part.selectExpr("id", "'lexicalCategory'", "category", "null"),
        part.selectExpr("id", "'lexicalForm'", "concat(id, '-F1')", "null"),
        part.selectExpr("concat(id, '-F1')", "'representation'", "form", "null"),
    ]
    # Written once: as a plan, every use of a label would repeat the expression that makes it.
    path = scratch_path(spark, "triples")
    reduce(DataFrame.union, facts).write.partitionBy("p").parquet(path)
    return spark.read.schema("s string, o string, lang string, p string").parquet(path)


def dictionary_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    known = triples(spark, sf_dir)
    given = dictionaries.name_words_only(dictionaries.labels_of(known, W.GIVEN_CLASSES))
    surnames = dictionaries.name_words_only(dictionaries.labels_of(known, W.SURNAME_CLASSES))
    forms, places = dictionaries.word_forms(known), dictionaries.labels_of(known, W.PLACE_CLASSES)
    ordinary = dictionaries.ordinary_words(forms, places)
    return given, surnames, ordinary, dictionaries.ambiguous_names(given, surnames, ordinary)


def list_words(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    return dictionary_parts(spark, sf_dir)[part]


def word_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionaries.word_forms(triples(spark, sf_dir))


def list_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    given, surnames, _, ambiguous = dictionary_parts(spark, sf_dir)
    stop = table(spark, sf_dir, "region").selectExpr("upper(left(r_name, 1)) || lower(substr(r_name, 2)) AS word")
    return dictionaries.merge_lists(given, surnames, ambiguous, stop.union(dictionaries.stop_list(spark)))


def list_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionaries.list_counts(list_merged(spark, sf_dir))


def word_list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words out to a text file, sorted, and in again."""
    path = scratch_path(spark, "words")
    lines = table(spark, sf_dir, "part").selectExpr("if(p_partkey % 10 = 0, concat('# ', p_name), p_name) AS word")
    words.write_words(lines.union(lines.selectExpr("''")).distinct(), path)
    return words.read_words(spark, path, comments=True)


def word_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word look-up result with header, quotes, blanks and repeats, cleaned."""
    path = scratch_path(spark, "tsv")
    cells = table(spark, sf_dir, "part").selectExpr(
        "concat(if(p_partkey % 3 = 0, '  ', ''), '\"', p_name, if(p_partkey % 5 = 0, '\u0001\rx', ''), '\"', "
        "if(p_partkey % 4 = 0, ' ', ''), if(p_partkey % 7 = 0, '\ufdd0', '')) AS cell"
    )
    cells = cells.union(table(spark, sf_dir, "region").selectExpr("'   '"))
    # the first row of a partition opens a file, so it brings the header line along
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    cells.select(F.concat(F.when(first, "?s\n").otherwise(""), "cell").alias("value")).write.text(path)
    return words.read_word_column(spark, path)


# --- scalars, chat, stream ----------------------------------------------------


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    repeated = F.concat(F.repeat(F.lit("a"), (F.col("c_custkey") % 9).cast("int")), name)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", scalars.greet(name).alias("greeting"), scalars.convert(repeated).alias("converted")
    )


def chat_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return asked.select("conv_id", "turn", scalars.chat_request("small", F.col("text")).alias("request"))


def chat_conversations(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    return conversations.conversation_requests(table(spark, sf_dir, "conversations"), "small", "conv_id", ["turn"], **limits)


def chat_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    message = F.struct(F.struct(F.col("role"), F.col("text").alias("content")).alias("message"))
    usage = F.struct(
        F.lit(1).alias("prompt_tokens"), F.length("text").alias("completion_tokens"),
        (F.length("text") + 1).alias("total_tokens"),
    )
    response = F.to_json(F.struct(F.array(message).alias("choices"), usage.alias("usage")))
    responses = answered.select("conv_id", "turn", response.alias("r"))
    parsed = responses.select("conv_id", "turn", scalars.chat_answer(F.col("r")).alias("a"))
    return parsed.select("conv_id", "turn", "a.answer", F.col("a.usage.total_tokens").alias("total_tokens"))


def redact_stream(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    """JSON lines through a stream into Parquet, then read back."""
    source, sink, state = (scratch_path(spark, f"stream-{part}") for part in ("in", "out", "state"))
    corpus.write_json_lines(orders_texts(spark, sf_dir, ALL_CASES), source)
    lines = stream.read_stream(spark, source, "o_orderkey bigint, text string")
    lexicon = name_lexicon(spark, sf_dir, **limits)
    stream.write_available(lines, "text", lexicon, sink, state).awaitTermination()
    return stream.read_redacted(spark, sink).select("o_orderkey", "redacted")


# --- the registry -------------------------------------------------------------


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: partial(run_sql, name=name) for name in acceptance.SPARK}
    found |= {
        "sql_max_rows": sql_max_rows,
        "records_json": records_json,
        "table_files": table_files,
        "cheaper_parts": cheaper_parts,
        "events_sliding_week": sliding_week,
        "events_running_count": running_count,
        "events_distinct_users": distinct_users,
    }
    found |= {f"redact_{family.lower()}": partial(redact_family, family=family) for family in templates.FAMILIES}
    texts = {
        "documents": (["doc_id"], "text"),
        "pages": (["page_id"], "html"),
        "conversations": (["conv_id", "turn"], "text"),
    }
    for name, (key, column) in texts.items():
        for profile in (CORE, FULL):
            found[f"redact_{name}_{profile}"] = partial(
                redact_table, name=name, key=key, column=column, profile=profile
            )
    found |= {
        "redact_changed_by_language": changed_by_language,
        "redact_profile_difference": profile_difference,
        "redact_core_sql": redact_core_sql,
    }
    found |= {group: partial(redact_by_name_rules, group=group) for group in templates.NAMES}
    found |= {
        "name_rules_joined_dictionary": partial(redact_by_name_rules, group="name_runs", max_shared_bytes=0),
        "redact_full": redact_full,
        "redact_full_joined_dictionary": partial(redact_full, max_shared_bytes=0),
        "redact_full_sql": redact_full_sql,
        "redact_full_sql_joined": partial(redact_full_sql, max_shared_bytes=0),
        "redact_full_table": redact_full_table,
        "redact_full_table_joined": partial(redact_full_table, max_shared_bytes=0),
        "redact_stream": redact_stream,
        "redact_stream_joined": partial(redact_stream, max_shared_bytes=0),
        "documents_with_names": documents_with_names,
        "score": score,
        "mismatches": mismatches,
        "scored_mismatches": scored_mismatches,
        "corpus_files": corpus_files,
        "nth_record": nth_record,
        "record_fields": record_fields,
        "record_projection": record_projection,
        "nth_record_fields": nth_record_fields,
        "lists_given": partial(list_words, part=0),
        "lists_surnames": partial(list_words, part=1),
        "lists_ordinary_words": partial(list_words, part=2),
        "lists_ambiguous": partial(list_words, part=3),
        "lists_word_forms": word_forms,
        "lists_merged": list_merged,
        "lists_counts": list_counts,
        "word_list_files": word_list_files,
        "word_column": word_column,
        "scalar_functions": scalar_functions,
        "chat_requests": chat_requests,
        "chat_conversations": chat_conversations,
        "chat_conversation_parts": partial(chat_conversations, part=600),
        "chat_answers": chat_answers,
    }
    return found


_LETTERS = "translate(lpad(cast({0} AS string), 9, '0'), '0123456789', 'abdefgiklm')"


def _labels(remainder: int, name_words: bool = True) -> str:
    word = _LETTERS.format("c_custkey // 3")
    label = LABEL.format(plain=f"(CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE 'K' END) || {word}", word=word)
    named = "CASE c_custkey % 13 WHEN 2 THEN true WHEN 4 THEN false WHEN 5 THEN true ELSE c_custkey % 7 <> 0 END"
    only = f"AND {named}" if name_words else ""
    return f"""
        SELECT DISTINCT {label} AS word FROM customer
        WHERE c_custkey % 4 = {remainder} AND c_custkey % 11 <> 0 {only}"""


def all_oracles() -> dict[str, str]:
    found = {name: acceptance.oracle(name) for name in acceptance.SPARK}
    found |= {
        "sql_max_rows": """
            SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2
            ORDER BY n DESC, event_type, user_id LIMIT 20""",
        "records_json": """
            SELECT json FROM (SELECT cast(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_acctbal': c_acctbal, 'n_orders': n_orders,
                                 'cents': '@' || (c_custkey % 100) || '.00@', 'last_day': cast(last_day AS varchar),
                                 'nested': {'key': c_nationkey, 'tags': [c_mktsegment, null]}}) AS varchar) AS j,
                   replace(replace(j, '"@', ''), '@"', '') AS json
            FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, cast(max(o_orderdate) AS date) AS last_day
                                     FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON o_custkey = c_custkey)""",
        "table_files": """
            SELECT l_returnflag, l_linenumber, count(*) AS n_rows, true AS agrees
            FROM lineitem GROUP BY l_returnflag, l_linenumber""",
        "cheaper_parts": """
            SELECT p.p_partkey, count(q.p_partkey) AS n_cheaper, cast(coalesce(sum(cast(q.p_retailprice AS decimal(15, 2))), 0) AS double) AS sum_cheaper
            FROM part p LEFT JOIN part q ON q.p_brand = p.p_brand AND q.p_retailprice < p.p_retailprice GROUP BY p.p_partkey""",
        "events_sliding_week": """
            SELECT event_id, count(*) OVER w AS n_week, cast(sum(cast(value AS decimal(15, 2))) OVER w AS double) AS value_week
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""",
        "events_running_count": """
            SELECT event_id, row_number() OVER w AS place,
                   cast(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w AS bigint) AS purchases
            FROM events WINDOW w AS (ORDER BY ts, event_id)""",
        "events_distinct_users": """
            SELECT event_type, day, CASE grouping(event_type, day) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END::INT AS grouping_level,
                   count(DISTINCT user_id) AS n_users
            FROM (SELECT event_type, cast(ts AS date) AS day, user_id FROM events) GROUP BY ROLLUP (event_type, day)""",
    }
    for family, cases in templates.FAMILIES.items():
        found[f"redact_{family.lower()}"] = templates.texts_sql(cases, 1, "redacted")
    for profile in (CORE, FULL):
        found[f"redact_documents_{profile}"] = oracles.chained("documents", "doc_id", "text", profile)
        found[f"redact_pages_{profile}"] = oracles.chained("pages", "page_id", "html", profile)
        found[f"redact_conversations_{profile}"] = oracles.chained("conversations", "conv_id, turn", "text", profile)
    found["redact_core_sql"] = found["redact_documents_core"]
    found["redact_changed_by_language"] = f"""
        SELECT lang, count(*) FILTER (redacted <> text) AS n_changed, count(*) AS n_docs
        FROM (SELECT lang, text, {oracles.chain('text', CORE)} AS redacted FROM documents) GROUP BY lang"""
    found["documents_with_names"] = f"SELECT doc_id, {placed_names(1)} AS redacted FROM documents"
    dates = templates.FAMILIES["DATE"]
    found["redact_profile_difference"] = f"""
        SELECT o_orderkey, 'am ' || day || '.01. und [TIME] Uhr, 9-[TIME] Uhr' AS core,
               'am [DATE] und [TIME] Uhr, 9-[TIME] Uhr' AS "full"
        FROM (SELECT o_orderkey, lpad(cast(o_orderkey % 28 + 1 AS string), 2, '0') AS day FROM orders)
        WHERE o_orderkey % {len(dates)} = 10"""
    for group, cases in templates.NAMES.items():
        found[group] = templates.texts_sql(cases, 1, "redacted")
    found["name_rules_joined_dictionary"] = found["name_runs"]
    found["redact_full"] = templates.texts_sql(ALL_CASES, 1, "redacted")
    for name in (
        "redact_full_joined_dictionary",
        "redact_full_sql",
        "redact_full_sql_joined",
        "redact_full_table",
        "redact_full_table_joined",
        "redact_stream",
        "redact_stream_joined",
    ):
        found[name] = found["redact_full"]

    pairs = f"""(
        SELECT t.o_orderkey AS row_id, text AS source, expected AS redacted,
               CASE WHEN t.o_orderkey % 10 = 0 THEN expected || ' ü' ELSE expected END AS target
        FROM ({templates.texts_sql(PHONE, 0, 'text')}) t
        JOIN ({templates.texts_sql(PHONE, 1, 'expected')}) e ON t.o_orderkey = e.o_orderkey) p"""
    message = "cast(to_json({'role': coalesce(role, ''), 'content': coalesce(text, '')}) AS varchar)"
    given, surnames, places = _labels(0), _labels(1), _labels(2, name_words=False)
    forms = f"""
        SELECT DISTINCT 'k' || {_LETTERS.format('p_partkey')} AS word FROM part
        WHERE p_partkey % 5 <> 0 AND p_partkey % 3 IN (0, 1)"""
    ordinary = f"({forms}) UNION ({places})"
    ambiguous = f"""
        SELECT word FROM (({given}) UNION ({surnames})) n
        WHERE (word IN (SELECT word FROM ({ordinary})) OR lower(word) IN (SELECT word FROM ({ordinary})))
          AND NOT list_contains({list(W.KNOWN_NAMES)}, word)"""
    merged = f"""
        SELECT word, bool_or(l = 1) AS is_given, bool_or(l = 2) AS is_surname, bool_or(l = 3) AS is_ambiguous,
               bool_or(l = 4) AS is_stop
        FROM (SELECT word, 1 AS l FROM ({given}) UNION ALL SELECT word, 2 FROM ({surnames})
              UNION ALL SELECT word, 3 FROM ({ambiguous})
              UNION ALL SELECT upper(left(r_name, 1)) || lower(substr(r_name, 2)), 4 FROM region
              UNION ALL SELECT unnest({list(W.STOP_WORDS)}), 4) GROUP BY word"""
    found |= {
        "score": f"""
            SELECT count(*) FILTER (redacted = target AND row_id % 11 <> 0) AS matches, count(*) AS n_rows
            FROM {pairs}""",
        "mismatches": f"""
            SELECT row_id, source, CASE WHEN row_id % 11 <> 0 THEN target END AS target, redacted FROM {pairs}
            WHERE redacted <> target OR row_id % 11 = 0""",
        "scored_mismatches": f"""
            SELECT row_id, redacted, matches, n_rows
            FROM (SELECT *, count(*) FILTER (redacted = target AND row_id % 11 <> 0) OVER () AS matches, count(*) OVER () AS n_rows FROM {pairs})
            WHERE redacted <> target OR row_id % 11 = 0""",
        "corpus_files": f"SELECT source, target FROM {pairs}",
        "nth_record": """
            SELECT unnest(['doc_id', 'lang', 'source', 'text']) AS "key",
                   unnest([cast(doc_id AS varchar), lang, source, text]) AS "value"
            FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 1 OFFSET 5)""",
        "record_fields": """
            SELECT row_id, "key", "value" FROM (
            SELECT o_orderkey AS row_id, unnest(['it''s checked', 'meta', 'row_id', 'source_text']) AS "key", unnest(vs) AS "value"
            FROM (SELECT *, [CASE WHEN o_orderkey % 5 = 0 THEN 'true' END,
                             CASE WHEN o_orderkey % 3 = 0 THEN '{"by":' || o_custkey || ',"tags":["' || o_orderstatus || '","ü"]}' END,
                             cast(o_orderkey AS varchar), CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END] AS vs FROM orders))
            WHERE "value" IS NOT NULL""",
        "record_projection": """
            SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 3 = 0 THEN '{"by":' || o_custkey || ',"tags":["' || o_orderstatus || '","ü"]}' END AS meta,
                   CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS first_tag FROM orders""",
        "nth_record_fields": """
            SELECT unnest(['it''s checked', 'meta', 'row_id', 'source_text']) AS "key",
                   unnest(['true', '{"by":' || o_custkey || ',"tags":["' || o_orderstatus || '","ü"]}', cast(o_orderkey AS varchar), o_orderpriority]) AS "value"
            FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 30)""",
        "lists_given": given,
        "lists_surnames": surnames,
        "lists_ordinary_words": ordinary,
        "lists_ambiguous": ambiguous,
        "lists_word_forms": forms,
        "lists_merged": merged,
        "lists_counts": f"""
            SELECT unnest(['given_names', 'surnames', 'ambiguous_names']) AS list, unnest([g, s, a]) AS n_words
            FROM (SELECT count(*) FILTER (is_given) AS g, count(*) FILTER (is_surname) AS s,
                         count(*) FILTER (is_ambiguous) AS a FROM ({merged}))""",
        "word_list_files": "SELECT DISTINCT p_name AS word FROM part WHERE p_partkey % 10 <> 0",
        "word_column": """
            SELECT DISTINCT p_name || CASE WHEN p_partkey % 5 = 0 THEN chr(1) || chr(13) || 'x' ELSE '' END
                   || CASE WHEN p_partkey % 7 = 0 THEN '"' || CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE '' END
                           || chr(64976) ELSE '' END AS word
            FROM part""",
        "scalar_functions": """
            SELECT c_custkey, 'Hello, ' || c_name || '!' AS greeting,
                   repeat('XXX', cast(c_custkey % 9 // 3 AS int)) || repeat('a', cast(c_custkey % 9 % 3 AS int))
                     || c_name AS converted
            FROM customer""",
        "chat_requests": """
            SELECT conv_id, turn,
                   cast(to_json({'model': 'small', 'messages': [{'role': 'user', 'content': text}]}) AS varchar) AS request
            FROM conversations WHERE role = 'user'""",
        "chat_conversations": f"""
            SELECT conv_id, 0::BIGINT AS part, count(*) AS n_turns,
                   '{{"model":"small","messages":[' || string_agg({message}, ',' ORDER BY turn NULLS FIRST, {message}) || ']}}' AS request
            FROM conversations GROUP BY conv_id""",
        "chat_conversation_parts": f"""
            WITH m AS (SELECT conv_id, {message} AS message, turn FROM conversations),
            r AS (SELECT *, length(message) + 1 AS size, sum(length(message) + 1) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, message) AS until,
                         sum(length(message) + 1) OVER (PARTITION BY conv_id) AS total, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, message) AS nth FROM m)
            SELECT conv_id, ((until - size) // 600)::BIGINT AS part, count(*) AS n_turns,
                   CASE WHEN min(nth) = 1 THEN '{{"model":"small","messages":[' ELSE ',' END || string_agg(message, ',' ORDER BY nth)
                     || CASE WHEN max(until) = max(total) THEN ']}}' ELSE '' END AS request
            FROM r GROUP BY conv_id, part""",
        "chat_answers": """
            SELECT conv_id, turn, text AS answer, cast(length(text) + 1 AS bigint) AS total_tokens
            FROM conversations WHERE role = 'assistant'""",
    }
    return found

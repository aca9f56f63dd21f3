"""Sources, sinks, SQL layer, scoring, small functions and the stream."""

import datetime
import json
import os

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from veilframe.functions import scalars
from veilframe.operators import queries, scoring
from veilframe.operators.lexicon import NameLexicon
from veilframe.operators.redaction import redact
from veilframe.plans import registry
from veilframe.session import scratch_path, spread
from veilframe.sources import corpus, files, tables, words
from veilframe.streaming import redact_stream as stream


@pytest.fixture
def lineitem(spark, sf_dir):
    return queries.ParquetQueries(spark, {"lineitem": f"{sf_dir}/lineitem.parquet"})


def test_directory_of_files_is_one_table(spark, tmp_path):
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).write.mode("append").parquet(str(tmp_path / "t"))
    assert tables.register_parquet(spark, "many_files", str(tmp_path / "t")).count() == 30
    assert spark.sql("SELECT sum(id) AS s FROM many_files").first().s == sum(range(30))


def test_only_queries_run(spark, lineitem):
    for sql in (
        "DESCRIBE lineitem",
        "-- x\nSHOW TABLES",
        "",
        "CREATE VIEW v AS SELECT 1",
        "DROP TABLE lineitem",
        "INSERT INTO lineitem SELECT * FROM lineitem",
        "SET x = 1",
        "SELECT 1) UNION ALL (SELECT 2",
        "WITH a AS (SELECT 1) INSERT INTO lineitem SELECT * FROM a",
    ):
        with pytest.raises((ParseException, AnalysisException, ValueError)):
            lineitem.query(sql).collect()
    for sql in ("SELECT 1 AS a;;", "SELECT 1 AS a; -- done", "SELECT 1 AS a ; /* so; */\n;\n", "/* x */ (SELECT 1 AS a)", "SELECT length(';--') - 2 AS a"):
        assert lineitem.query(sql).first().a == 1
    assert lineitem.query("SELECT 1 AS a -- done").first().a == 1
    assert lineitem.query(" SELECT 1 AS a ; ").first().a == 1
    ordered = lineitem.query("SELECT DISTINCT l_linenumber AS n FROM lineitem ORDER BY n DESC", max_rows=3)
    assert [r.n for r in ordered.collect()] == sorted((r.n for r in ordered.collect()), reverse=True)


def test_calls_share_no_state(spark, lineitem):
    lineitem.session().sql("CREATE TEMPORARY VIEW leftover AS SELECT 1")
    with pytest.raises(AnalysisException):
        lineitem.query("SELECT * FROM leftover")


def test_catalog(lineitem):
    assert [r.name for r in lineitem.tables().collect()] == ["lineitem"]
    described = lineitem.schema("lineitem").collect()
    assert [(r.name, r.data_type, r.nullable) for r in described][:1] == [("l_orderkey", "bigint", True)]
    with pytest.raises(AnalysisException):
        lineitem.schema("nothing")
    nested = tables.describe_table_nested(lineitem.session(), "lineitem").first()
    assert nested.table == "lineitem" and [c["name"] for c in nested.columns] == [r.name for r in described]


def test_pushdown_reaches_the_scan(lineitem):
    df = lineitem.query("SELECT avg(l_extendedprice) AS p FROM lineitem WHERE l_quantity > 40")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan


def test_records(spark, capsys):
    df = spark.sql("SELECT 1 AS a, cast(null AS string) AS b, double('NaN') AS c, named_struct('x', null) AS d")
    assert json.loads(queries.records(df).first().json) == {"a": 1, "b": None, "c": "NaN", "d": {"x": None}}
    with pytest.raises(ValueError):
        queries.records(spark.sql("SELECT 1 AS a, 2 AS a"))
    queries.print_query(spark, "SELECT id FROM range(300)")
    assert capsys.readouterr().out.count("\n|") == 301
    queries.print_query(spark, "SELECT 19.5 AS fare")
    shown = capsys.readouterr().out
    assert shown.startswith("Query: SELECT 19.5 AS fare\n+----+\n|fare|") and "|19.5|" in shown


def test_printed_table_is_what_show_prints(spark, capsys):
    rows = spark.range(40).selectExpr(
        "id", "if(id % 3 = 0, null, repeat('ä漢', cast(id % 5 AS int))) AS `a\tb`", "id / 7 AS d", "cast(id AS decimal(10, 3)) AS e",
        "array(id, id + 1) AS f", "named_struct('x', id, 'y', 'z') AS g", "encode(concat('é', id), 'utf-8') AS h", "concat('x', chr(10), chr(9), '😀') AS i",
        "timestamp '2024-01-02 03:04:05.6' + make_interval(0, 0, 0, 0, 0, 0, id) AS t", "id % 2 = 0 AS k", "map('a', id) AS m", "date '2024-01-02' AS n",
    )
    for df in (rows, rows.repartition(3).orderBy("id"), rows.limit(0), spark.range(3).selectExpr("id AS `漢字`")):
        df.show(1000, truncate=False)
        shown = capsys.readouterr().out
        queries.print_table(df)
        assert capsys.readouterr().out == shown


def test_pairs_are_strict(spark, tmp_path):
    def read(*lines):
        path = tmp_path / f"{len(os.listdir(tmp_path))}.json"
        path.write_text("\n".join(lines))
        return corpus.read_pairs(spark, str(path))

    good = '{"source": "a", "target": "b", "more": 1}'
    assert read(good).collect() == [("a", "b")]
    for bad in ('{"source": "a"}', '{"source": "a", "target": null}', "{broken"):
        with pytest.raises(Exception, match="missing field|[Mm]alformed"):
            read(good, bad).count()
        with pytest.raises(Exception, match="missing field|[Mm]alformed"):
            read(good, bad).select("source").collect()


def test_json_lines(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    spark.createDataFrame([("für", None, 3)], "source_text string, x string, n int").withColumn(
        "target_text", F.lit("[A]")
    ).write.json(raw)
    corpus.write_json_lines(scoring.project_pairs(corpus.read_raw_corpus(spark, raw)), out)
    (line,) = [r.value for r in spark.read.text(out).collect()]
    assert line == '{"source":"f\\u00FCr","target":"[A]"}'
    assert corpus.read_pairs(spark, out).collect() == [("für", "[A]")]


def test_words(spark, tmp_path):
    source, sink = tmp_path / "stop.txt", str(tmp_path / "sorted")
    source.write_text("# comment\nDer\n\nAnna\nÜber\nzu\n")
    assert words.read_words(spark, str(source)).count() == 6
    stop = words.read_words(spark, str(source), comments=True)
    words.write_words(stop.repartition(4), sink)
    lines = [
        line
        for name in sorted(os.listdir(sink))
        if name.startswith("part")
        for line in open(f"{sink}/{name}", encoding="utf-8").read().splitlines()
    ]
    assert lines == sorted(["Der", "Anna", "Über", "zu"])


def test_word_column(spark, tmp_path):
    path = tmp_path / "words.tsv"
    path.write_text('?s\n"Anna"\n  "Peter" \n\n   \n"Anna"\n""\nO\\"Neil\na\tb\n')
    expected = {line.strip().strip('"') for line in path.read_text().split("\n")[1:] if line.strip()}
    assert {r.word for r in words.read_word_column(spark, str(path)).collect()} == expected


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("abc")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.txt").write_text("x")
    os.utime(tmp_path / "a.txt", (0, 86399 + 86400 * 364))
    assert [r.path.rsplit("/", 1)[1] for r in files.list_files(spark, str(tmp_path)).collect()] == ["a.txt"]
    (fact,) = files.file_facts(spark, f"{tmp_path}/a.txt").collect()
    assert (fact["size"], fact.modified) == (3, "1970-12-31")
    with pytest.raises(AnalysisException):
        files.file_facts(spark, f"{tmp_path}/nothing").collect()


def test_table_files(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    (fact,) = files.table_files(spark.read.parquet(path)).collect()
    changed = datetime.datetime.fromtimestamp(os.path.getmtime(path), datetime.UTC).strftime("%Y-%m-%d")
    expected = ("orders.parquet", os.path.getsize(path), changed, spark.read.parquet(path).count())
    assert tuple(fact) == expected


def test_scoring(spark):
    pairs = spark.createDataFrame(
        [(1, "am 05.01.64", "am [DATE]"), (2, "um 10:00", "um 10:00"), (3, "x", "x")], "n int, source string, target string"
    )
    flagged = scoring.flag_matches(redact(pairs, "source"))
    assert scoring.score(flagged).first() == (2, 3)
    assert scoring.mismatches(flagged, "n").collect() == [(2, "um 10:00", "um 10:00", "um [TIME]")]
    plan = scoring.mismatches(flagged)._jdf.queryExecution().optimizedPlan().toString()
    once = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == once.count("regexp_replace(")
    nulls = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("b", "b")], "redacted string, target string")
    flagged = scoring.flag_matches(nulls.withColumn("source", F.lit("s")))
    assert scoring.score(flagged).first() == (2, 4) and len(scoring.mismatches(flagged).collect()) == 2
    assert scoring.nth_record(pairs, "n", 1).collect()[1] == ("source", "um 10:00")


def test_scalars(spark):
    df = spark.createDataFrame([("Bo", "aaaaaaa b"), (None, None)], "n string, t string")
    rows = df.select(scalars.greet(F.col("n")), scalars.convert(F.col("t"))).collect()
    assert rows == [("Hello, Bo!", "XXXXXXa b"), (None, None)]
    request = df.select(scalars.chat_request("m", F.col("t"))).first()[0]
    assert json.loads(request) == {"model": "m", "messages": [{"role": "user", "content": "aaaaaaa b"}]}
    response = json.dumps({"choices": [{"message": {"content": "hi"}}], "usage": {"total_tokens": 3}, "id": 1})
    answer = spark.createDataFrame([(response,)], "r string").select(scalars.chat_answer(F.col("r")).alias("a")).first().a
    assert answer.answer == "hi" and answer.usage.total_tokens == 3


def test_stream_restarts_where_it_stopped(spark, tmp_path, name_words):
    source, sink, state = (str(tmp_path / part) for part in ("in", "out", "state"))
    lexicon = NameLexicon(name_words)

    def run():
        lines = stream.read_stream(spark, source, "id bigint, text string", files_per_batch=1)
        stream.write_available(lines, "text", lexicon, sink, state).awaitTermination()
        return sorted((r.id, r.redacted) for r in stream.read_redacted(spark, sink).collect())

    def add(*rows):
        spark.createDataFrame(rows, "id bigint, text string").coalesce(1).write.mode("append").json(source)

    add((1, "Herr Schmidt um 10:00"))
    assert run() == [(1, "[TITLE] [LASTNAME1] um [TIME]")]
    add((2, "x"))
    add((3, "wie Anna Royer"))
    assert run() == [(1, "[TITLE] [LASTNAME1] um [TIME]"), (2, "x"), (3, "wie [GIVENNAME1] [LASTNAME1]")]
    lexicon = NameLexicon(name_words, max_shared_bytes=0)
    add((4, "Frau Anna"))
    assert run()[3:] == [(4, "[TITLE] [GIVENNAME1]")]
    (tmp_path / "in" / "bad.json").write_text('{"id": 5}\n')
    with pytest.raises(Exception, match="missing field"):
        run()


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{shared}/veilframe/x-")


def test_spread_only_small_scans(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=50)
    assert spread(many) is many


def test_one_row_group_is_spread(spark, tmp_path):
    """A scan of many splits, one of which holds all rows, becomes tasks of about as many rows each."""
    rows = spark.range(0, 600_000, 1, 1).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "rand() AS other")
    path = tmp_path / "orders.parquet"
    rows.write.option("parquet.block.size", 1 << 30).parquet(str(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", sum(f.stat().st_size for f in path.glob("part-*")) // 9)
    try:
        assert 8 <= spark.read.parquet(str(path)).rdd.getNumPartitions() < 12
        texts = registry.orders_texts(spark, str(tmp_path), registry.ALL_CASES)
        sizes = [r["count"] for r in texts.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(sizes) == 600_000 and max(sizes) < 60_000
    few = spread(spark.range(1000).repartition(2), 20)
    assert few.rdd.getNumPartitions() == 50

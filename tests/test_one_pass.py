"""Large dictionaries behind a filter, the table function, the stream's commits, one-pass scoring, corpora with any keys."""

import json

import pytest
from pyspark.sql import functions as F

from veilframe.functions.register import register_redact_table
from veilframe.operators import scoring
from veilframe.operators.lexicon import NameLexicon
from veilframe.operators.lookup import candidate_words
from veilframe.operators.redaction import redact
from veilframe.sources import corpus
from veilframe.streaming import redact_stream as stream

TEXTS = [
    (1, "Herr Schmidt und Anna Maria Schmidt-Royer kamen am 1.2.2024.", "x"),
    (2, None, "x"),
    (3, "", None),
    (4, "Vorname: Anna; gez. Peter Berg", "y"),
    (4, "Vorname: Anna; gez. Peter Berg", "y"),
    (5, "Nothing Here Is Listed but Zqanna Zqschmidt", "y"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, text string, kind string")


def test_filter_loses_no_listed_word(spark, name_words):
    many = spark.range(5000).select(F.concat(F.lit("Wort"), F.col("id")).alias("word"), *[F.lit(True).alias(c) for c in name_words.columns[1:]])
    lexicon = NameLexicon(name_words.union(many), max_shared_bytes=0)
    tried = lexicon.flags.select("word").union(spark.range(20000).select(F.concat(F.lit("Kein"), F.col("id"))))
    tried = tried.where("word rlike '^[A-Z][a-z0-9]+$'")
    passed = {r.word for r in tried.select(F.explode(F.expr(lexicon.words_to_join("initcap(word)").replace(candidate_words("initcap(word)"), "array(word)"))).alias("word")).collect()}
    listed = {r.word for r in lexicon.flags.where("word rlike '^[A-Z][a-z0-9]+$'").collect()}
    assert listed <= passed and len(passed - listed) < 400  # of 20,000
    lexicon.drop()


def test_saturated_filter_changes_nothing(spark, name_words, texts, monkeypatch):
    expected = sorted(map(str, redact(texts, "text", NameLexicon(name_words)).collect()))
    for bits in (1 << 26, 64):
        monkeypatch.setattr("veilframe.operators.lexicon.MAX_FILTER_BITS", bits)
        assert sorted(map(str, redact(texts, "text", NameLexicon(name_words, max_shared_bytes=0)).collect())) == expected
    empty = NameLexicon(name_words.limit(0), max_shared_bytes=0, stop_words=())
    assert empty.n_words == 0 and redact(texts, "text", empty).count() == len(TEXTS)


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_table_function(spark, name_words, texts, limit):
    texts.createOrReplaceTempView("veil_test_texts")
    lexicon = NameLexicon(name_words, max_shared_bytes=limit)
    register_redact_table(spark, lexicon, "veil_test_texts", "text", "veil_test_redacted")
    rows = spark.sql("SELECT * FROM veil_test_redacted()")
    assert rows.columns == ["id", "text", "kind", "redacted"]
    assert sorted(map(str, rows.collect())) == sorted(map(str, redact(texts, "text", lexicon).collect()))
    assert {r.id for r in spark.sql("SELECT id FROM veil_test_redacted() WHERE kind = 'y'").collect()} == {4, 5}


def test_stream_reads_committed_batches_only(spark, name_words, tmp_path):
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    lexicon = NameLexicon(name_words)

    def run(k):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"id": k, "text": "Vorname: Anna"}) + "\n")
        stream.write_available(stream.read_stream(spark, source, "id bigint, text string"), "text", lexicon, sink, state).awaitTermination()

    with pytest.raises(ValueError):
        stream.read_redacted(spark, sink)
    run(1)
    run(2)
    first, second = stream.committed(spark, sink)
    spark.createDataFrame([(9, "x", "y")], "id bigint, text string, redacted string").write.parquet(f"{sink}/batch-2-broken")  # broke off
    assert sorted(r.id for r in stream.read_redacted(spark, sink).collect()) == [1, 2]
    (tmp_path / "state" / "commits" / "1").unlink()  # the stream broke off after writing, before its checkpoint
    (tmp_path / "state" / "commits" / ".1.crc").unlink(missing_ok=True)
    run(3)
    assert stream.committed(spark, sink)[:2] == [first, second]
    assert sorted(r.id for r in stream.read_redacted(spark, sink).collect()) == [1, 2, 3]
    (tmp_path / "out" / "_commits" / "7").write_text("")  # just being created
    assert sorted(r.id for r in stream.read_redacted(spark, sink).collect()) == [1, 2, 3]


def test_score_and_mismatches_in_one_pass(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "a", "a"), (2, "b", "x"), (3, None, "c"), (4, "d", None), (5, None, None)], "id int, source string, target string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    flagged = scoring.flag_matches(pairs.select("*", F.explode(F.array(counted("source"))).alias("redacted")))
    counts, rows = scoring.score_and_mismatches(flagged, str(tmp_path / "rows"), "id")
    assert counts == {"matches": 2, "n_rows": 5} and sorted(r.id for r in rows.collect()) == [2, 3, 4]
    assert seen.value == 5  # each row once, for both results
    counts, rows = scoring.score_and_mismatches(flagged.limit(0), str(tmp_path / "none"), "id")
    assert counts == {"matches": 0, "n_rows": 0} and rows.collect() == []


def test_corpus_with_any_keys(spark, tmp_path):
    lines = [
        {"row_id": 2, "source_text": "ä", "tags": ["x", {"y": 1.5}], "it's": None},
        {"row_id": 10, "meta": {"by": {"name": "z"}}, "flag": True, "target_text": ""},
        {"other": "no number"},
        {},
    ]
    (tmp_path / "c.json").write_text("".join(json.dumps(x) + "\n" for x in lines))
    records = corpus.read_records(spark, str(tmp_path / "c.json")).withColumn("k", corpus.field("row_id", kind="bigint"))
    got = {(r.k, r.key): r.value for r in corpus.record_fields(records, "k").collect()}
    assert got == {
        (2, "row_id"): "2", (2, "source_text"): "ä", (2, "tags"): '["x",{"y":1.5}]', (2, "it's"): None, (10, "row_id"): "10",
        (10, "meta"): '{"by":{"name":"z"}}', (10, "flag"): "true", (10, "target_text"): "", (None, "other"): "no number",
    }
    names = {r[0] for r in records.select(corpus.field("meta", "by", "name")).collect()}
    assert names == {None, "z"} and [r[0] for r in records.select(corpus.field("tags", 0)).where("k = 2").collect()] == ["x"]
    assert {r.key: r.value for r in scoring.nth_record_fields(records, "row_id", 2).collect()} == {"row_id": "2", "source_text": "ä", "tags": '["x",{"y":1.5}]', "it's": None}
    assert scoring.nth_record_fields(records, "row_id", 9).collect() == []
    for bad in ("[1]", '{"a":', "null", "7"):
        (tmp_path / "bad.json").write_text(bad + "\n")
        with pytest.raises(Exception, match="no JSON object|MALFORMED"):
            corpus.read_records(spark, str(tmp_path / "bad.json")).collect()

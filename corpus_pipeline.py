"""The corpus pipeline: five operators in a row over ``documents``, each stage written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``.  It works on all rows its predecessor kept, and what it decides takes effect:

1. quality: documents that the co-trained classifier rejects go;
2. lines: later copies of repeated runs of three lines or of more than ``line_dedup.MIN_WORDS`` words
   are cut out, ``n_chars`` follows the text, and documents of which nothing is left go; rows of equal
   text are one for the shorter runs, stage 3 drops all but one of them;
3. near_duplicates: of each class of documents linked by SimHash fingerprints (three-word shingles,
   at most three differing bits) the first by id stays;
4. decontamination: documents that hold a benchmark item go;
5. mix: sources are mixed to their target weights; ``copies`` says how often a document is taken
   and documents that aren't taken go.

Defined cases: those of the operators.  A row without id has the least id; of rows equal in id and
text one stays in stage 3.  Columns beyond those of ``documents`` are carried along.  An empty
table passes through all stages.  SQL can't express stages 1 and 3, so there is no ORACLE_SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import classifier, decontaminate, line_dedup, mixing, simhash
from veilframe.llm.shared import fresh, row_key, stored, table

ORACLE_SQL = None


def _join_rows(docs: DataFrame, found: DataFrame, how: str, *extra: str) -> tuple[DataFrame, list[str]]:
    """``docs`` joined with ``found`` (key_id, key_hash, extra) by row, and the names of the keys and extra columns."""
    names = fresh(docs, "row_id", "row_hash", "found_id", "found_hash", *extra)
    i, h, j, k = names[:4]
    keyed = docs.withColumns(dict(zip((i, h), row_key(F.col("doc_id"), F.col("text")), strict=True)))
    return keyed.join(found.toDF(j, k, *names[4:]), (F.col(i) == F.col(j)) & (F.col(h) == F.col(k)), how), names


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = classifier.classified(*classifier.co_train(docs, table(spark, sf_dir, "labels"), docs.columns))
    names = fresh(docs, "p_text", "p_meta", "p_good", "accepted")
    scored = scored.toDF(*docs.columns, *names)
    return scored.where(f"`{names[-1]}`").select(*[f"`{c}`" for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    total, gone = fresh(docs, "lines_total", "lines_gone")
    cut = line_dedup.dedup_lines(docs, counts=(total, gone), min_words=line_dedup.MIN_WORDS, whole_texts=True)
    cut = cut.where((F.col(gone) == 0) | (F.col(gone) < F.col(total)))
    n_chars = F.when(F.col(gone) == 0, F.col("n_chars")).otherwise(F.length("text"))
    return cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.select(*row_key(F.col("doc_id"), F.col("text")), "doc_id", "text")
    classes = simhash.near_duplicates(keyed)
    firsts = classes.groupBy("component").agg(F.min(F.struct("key_id", "key_hash")).alias("first")).select("first.*")
    kept, (i, h, *_) = _join_rows(docs, firsts, "left_semi")
    return kept.dropDuplicates([i, h]).drop(i, h)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.mix(docs).where("taken > 0").select("key_id", "key_hash", (F.col("taken") / F.col("size")).cast("long").alias("copies"))
    both, names = _join_rows(docs, taken.dropDuplicates(["key_id", "key_hash"]), "inner", "copies")
    return both.select(*[f"`{c}`" for c in docs.columns], names[-1])


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

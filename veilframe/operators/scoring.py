"""Corpus preparation and scoring against labelled text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from veilframe.sources import corpus


def project_pairs(corpus: DataFrame) -> DataFrame:
    """``source`` and ``target`` of a raw corpus."""
    return corpus.select(F.col("source_text").alias("source"), F.col("target_text").alias("target"))


def flag_matches(df: DataFrame, redacted: str = "redacted", target: str = "target") -> DataFrame:
    """Add ``match``: the redacted text equals the target exactly; null equals null only.

    ``redacted`` should come from ``operators.redaction.redact``, whose output later
    filters do not compute again.
    """
    return df.withColumn("match", F.col(redacted).eqNullSafe(F.col(target)))


def score(flagged: DataFrame) -> DataFrame:
    """One row: how many match, of how many."""
    return flagged.agg(F.count_if("match").alias("matches"), F.count("*").alias("n_rows"))


def mismatches(flagged: DataFrame, *extra: str) -> DataFrame:
    """The rows that do not match; a row without a flag is one of them."""
    return flagged.filter(~F.coalesce("match", F.lit(False))).select(*extra, "source", "target", "redacted")


def score_and_mismatches(flagged: DataFrame, path: str, *extra: str) -> tuple[dict[str, int], DataFrame]:
    """Both results in one pass: matches and n_rows, and the mismatches, which are written to ``path`` as Parquet.

    The counts are taken on the way, so what made the flags runs once.
    """
    seen = Observation()
    counts = F.coalesce(F.count_if("match"), F.lit(0)).alias("matches"), F.count(F.lit(1)).alias("n_rows")
    mismatches(flagged.observe(seen, *counts), *extra).write.parquet(path)
    return seen.get, flagged.sparkSession.read.parquet(path)


def nth_record_fields(records: DataFrame, order_by: str, n: int) -> DataFrame:
    """All keys and values of the record at position ``n`` (from 0) in the order of the key ``order_by``, a whole number.

    ``records`` is what ``corpus.read_records`` returns; records without the key come first.
    """
    row = records.orderBy(corpus.field(order_by, kind="bigint"), F.to_json("record")).offset(n).limit(1)
    return corpus.record_fields(row).select("key", "value")


def nth_record(df: DataFrame, order_by: str, n: int) -> DataFrame:
    """The row at position ``n`` (from 0) in the order of ``order_by``, as key/value rows."""
    row = df.orderBy(order_by).offset(n).limit(1)
    pairs = [F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
    return row.select(F.inline(F.array(*pairs)))

"""Helpers of the operators: word pattern, written intermediate tables, row keys, ranks."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.session import remove_scratch, scratch_path

#: A word: anything between blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again.

    Cuts the lineage with files that every executor sees; a lost executor costs nothing
    that is already written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replaced(old: DataFrame, df: DataFrame, label: str) -> DataFrame:
    """``stored(df)``, made from ``old``, which ``stored`` returned and nobody reads any more: its files are removed.

    So are, soon, the shuffle files of what ran before: Spark drops those of plans that the driver has collected.
    """
    spark, new = df.sparkSession, stored(df, label)
    for folder in {file.rsplit("/", 1)[0] for file in old.inputFiles()}:
        remove_scratch(spark, folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return new


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands at most so many rows at a time to Python, which bounds its memory when rows are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two longs, never null, that name a row: its id and a hash of its text.

    Rows that agree in both are the same row repeated; they share every result.
    """
    return [
        F.coalesce(doc_id.cast("long"), F.lit(-(2**63))).alias("key_id"),
        F.xxhash64(F.lit(7), F.coalesce(text, F.lit(""))).alias("key_hash"),
    ]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name one that no column of ``df`` has, whatever its letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: list[str], amount: str, total: str) -> DataFrame:
    """Add ``total``: the sum of ``amount`` over all rows before, in the order of ``order``.

    No single task sees all rows: they are dealt by range, written, summed by partition,
    and each partition adds the sum of those before it (one row for each partition).
    """
    n = partitions(df.sparkSession)
    dealt = stored(df.repartitionByRange(n, *order).withColumn("rt_part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy("rt_part").agg(F.sum(amount).alias("rt_sum"))
    before = F.coalesce(F.sum("rt_sum").over(Window.orderBy("rt_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("rt_part", before.cast("long").alias("rt_before"))
    inside = Window.partitionBy("rt_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(F.broadcast(offsets), "rt_part")  # at most n rows
        .withColumn(total, F.col("rt_before") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("rt_part", "rt_before")
    )


def with_following(df: DataFrame, key: str, value: str, following: str) -> DataFrame:
    """``df``, whose ``key`` tells rows apart and isn't null, with ``following``: the ``value`` of the row with the next key, null for the last.

    Rows are dealt by range; each range's last row gets the first of the next range (one row for each).
    """
    n = partitions(df.sparkSession)
    dealt = stored(df.repartitionByRange(n, key).withColumn("rt_part", F.spark_partition_id()), "ranges")
    firsts = dealt.groupBy("rt_part").agg(F.min_by(value, key).alias("rt_value"))
    after = F.lead("rt_value").over(Window.orderBy("rt_part"))
    firsts = firsts.select(F.col("rt_part").alias("rt_p"), after.alias("rt_next"))
    inside = Window.partitionBy("rt_part").orderBy(key)
    placed = dealt.withColumns({"rt_last": F.lead(F.lit(False), 1, True).over(inside), following: F.lead(value).over(inside)})
    joined = placed.join(F.broadcast(firsts), F.col("rt_part") == F.col("rt_p"))
    return joined.withColumn(following, F.when(F.col("rt_last"), F.col("rt_next")).otherwise(F.col(following))).drop("rt_part", "rt_p", "rt_last", "rt_next")


def pack(numbers: np.ndarray) -> bytes:
    """Numbers from -1 on as four planes of bytes, which compress well since most numbers are small."""
    return (numbers + 1).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel().astype(np.int64) - 1

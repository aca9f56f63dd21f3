"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "veilframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is tested with.

    On a cluster the master and the memory come from the submit command; only
    settings that change results (time zone) or skew handling are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session, so that every executor sees
    the files.  Only a local session without it falls back to the machine's own
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="veilframe-")
    return f"{shared.rstrip('/')}/veilframe/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again, so that it is computed once and keeps its partitions' content."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a task where each row is a page of text, and where it is a sentence.
PAGES, SENTENCES = 2_000, 50_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Repartition a freshly scanned table that has fewer partitions than cores or, given ``rows``, more rows in a
    partition than that.

    A small Parquet file is one task however many cores there are, and so is a row group: a scan may have partitions
    without rows and others that hold millions. The rule chain is CPU-bound, and the tasks with the most rows then decide
    how long it takes. The rows are counted from the footers of the files; they are shuffled before any work on them.
    Only for scans: counting the partitions of a plan with joins could run part of it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-df.count() // rows)) if rows else cores
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df

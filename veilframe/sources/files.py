"""Files of a directory and of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the files of a directory (not recursive); contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path").orderBy("path")


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and UTC date of change of a file, or of each file of a directory."""
    modified = F.to_utc_timestamp("modificationTime", F.current_timezone())
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(F.col("path").alias("name"), F.col("length").alias("size"), _date(modified).alias("modified"))
    )


def table_files(df: DataFrame, paths: bool = False) -> DataFrame:
    """The files behind a scanned table: name (with ``paths`` the whole path), size, date of change, rows.

    Files are told apart by path, since parts of a partitioned table may share a name.
    """
    meta = F.col("_metadata")
    modified = F.to_utc_timestamp(meta["file_modification_time"], F.current_timezone())
    return (
        df.select(
            meta["file_path"].alias("path"), meta["file_name"].alias("name"), meta["file_size"].alias("size"), _date(modified).alias("modified")
        )
        .groupBy("path", "name", "size", "modified")
        .agg(F.count("*").alias("n_rows"))
        .select(F.col("path").alias("name") if paths else "name", "size", "modified", "n_rows")
    )


def _date(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd")

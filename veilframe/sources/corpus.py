"""JSON-lines corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAIR_SCHEMA = "source string, target string"
RAW_SCHEMA = "source_text string, target_text string"


def _read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with required fields: a malformed line or a missing field aborts the run.

    Spark's fail-fast mode accepts a missing field, so that is tested on top, in a
    filter, which stays in the plan whatever columns are read later.
    """
    return required(spark.read.schema(schema).option("mode", "FAILFAST").json(path))


def required(df: DataFrame) -> DataFrame:
    """``df``, a table or a stream; a null in any column aborts the run."""
    present = F.lit(True)
    for name in df.columns:
        present = present & F.col(name).isNotNull()
    problem = F.raise_error(F.lit(f"missing field, expected: {', '.join(df.columns)}")).cast("boolean")
    return df.filter(F.when(present, F.lit(True)).otherwise(problem))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Scoring pairs: ``source`` and ``target``, both required."""
    return _read_strict(spark, path, PAIR_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with whatever keys they have: one VARIANT column ``record``, an object in each row.

    Keys may differ from line to line and nest; nothing is inferred, so nothing is read twice.  A line
    that is no JSON object aborts the run.
    """
    raw = spark.read.option("singleVariantColumn", "record").option("mode", "FAILFAST").json(path)
    is_object = F.schema_of_variant("record").startswith("OBJECT")
    problem = F.raise_error(F.lit("a line is no JSON object")).cast("boolean")
    return raw.filter(F.when(is_object, F.lit(True)).otherwise(problem))


def field(*path: str | int, kind: str = "string") -> Column:
    """The value at a path of keys and places in ``record``: null where it is missing or of another kind, an object or array as JSON."""
    return F.try_variant_get("record", "$" + "".join(f"[{step!r}]" for step in path), kind)


def record_fields(records: DataFrame, *keep: str) -> DataFrame:
    """One row for each key of each record: ``keep``, pos (place in the order of keys), key, value (as text; null for null)."""
    exploded = records.select(*keep, "record").lateralJoin(records.sparkSession.tvf.variant_explode(F.col("record").outer()))
    return exploded.select(*keep, "pos", "key", F.col("value").cast("string").alias("value"))


def read_raw_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The two text columns of a raw corpus; ``read_records`` reads all keys."""
    return _read_strict(spark, path, RAW_SCHEMA)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object per row, all fields written, non-ASCII characters escaped."""
    (
        df.write.option("writeNonAsciiCharacterAsCodePoint", "true")
        .option("ignoreNullFields", "false")
        .mode("errorifexists")
        .json(path)
    )

"""Word lists as text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_words(spark: SparkSession, path: str, comments: bool = False) -> DataFrame:
    """One word per line; with ``comments``, blank lines and lines starting with # are skipped."""
    words = spark.read.text(path).select(F.col("value").alias("word"))
    if comments:
        words = words.filter((F.col("word") != "") & ~F.startswith(F.col("word"), F.lit("#")))
    return words


def write_words(words: DataFrame, path: str) -> None:
    """The words in code point order, one per line.

    Sorted by ranges, so that the part files in name order are the sorted list and
    no single task holds it.
    """
    words.select("word").orderBy("word").write.mode("errorifexists").text(path)


def read_word_column(spark: SparkSession, path: str) -> DataFrame:
    """A one-column TSV with a header line: distinct cells without blanks and quotes around them."""
    # Lines end at \n alone.  A line that holds the separator counts as malformed, and the reader keeps it whole in ``raw``.
    lines = (
        spark.read.schema("line string, raw string")
        .options(header="true", sep="\ufdd0", lineSep="\n", quote="", escape="", maxCharsPerColumn="-1")
        .options(enforceSchema="true", columnNameOfCorruptRecord="raw")
        .csv(path)
    )
    stripped = F.regexp_replace(F.coalesce("raw", "line"), r"(?U)^\s+|\s+\z", "")
    return (
        lines.select(stripped.alias("line"))
        .filter(F.col("line") != "")
        .select(F.regexp_replace("line", '^"+|"+\\z', "").alias("word"))
        .distinct()
    )

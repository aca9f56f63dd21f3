"""Name dictionaries and how a row reaches them.

A dictionary is a table ``name_words(word, is_given, is_surname, is_ambiguous,
is_stop)``.  Before the name rules run, each row gets the part of it that its text
needs, as a small look-up table (see ``operators.lookup``).

* A dictionary whose measured size stays below ``MAX_SHARED_BYTES`` is published
  as a session variable.  Spark ships it with the tasks, and the row picks its
  words from it; the text is not shuffled.
* A larger one stays distributed and is joined with the distinct words of each text.
  Rows and their texts are written once to the shared folder, so nothing that made
  them runs again.  A Bloom filter over the dictionary, built in Spark and never more
  than ``MAX_FILTER_BITS``, drops most unlisted words before they are shuffled; with
  more words than it has room for it only drops fewer.

Both give the same result, since look-ups are by word.  The built-in stop words are
part of every dictionary unless others are given.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from copy import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions import word_lists as W
from veilframe.functions.sqltext import evaluated_once, quoted
from veilframe.operators.lookup import EDGE, FLAG_DIGITS, MID, candidate_words, entry, filter_places, needed_words, perhaps_listed, row_table
from veilframe.session import remove_scratch, scratch_path

MAX_SHARED_BYTES = 32 * 1024 * 1024
MAX_FILTER_BITS, FILTER_BITS_PER_WORD = 1 << 26, 12
WORDS_PER_BUCKET = 4
# what a word costs besides its own bytes: marks, flag, its share of a bucket
WORD_OVERHEAD = 16

FLAG_COLUMNS = {"is_given": 1, "is_surname": 2, "is_ambiguous": 4, "is_stop": 8}


def word_flags(name_words: DataFrame, stop_words: Iterable[str] = W.STOP_WORDS) -> DataFrame:
    """``name_words`` and the stop words with one row per word and the four flags as one number."""
    total = sum(
        (F.when(F.col(name), F.lit(bit)).otherwise(F.lit(0)) for name, bit in FLAG_COLUMNS.items()), F.lit(0)
    )
    stops = [(word, FLAG_COLUMNS["is_stop"]) for word in stop_words]
    stop_flags = name_words.sparkSession.createDataFrame(stops, "word string, flags int")
    return (
        name_words.select("word", total.alias("flags"))
        .union(stop_flags)
        # a word that holds a mark of the look-up table can never be offered
        .filter(~F.rlike("word", F.lit(f"[{EDGE}{MID}]")))
        .groupBy("word")
        .agg(F.bit_or("flags").cast("int").alias("flags"))
    )


class NameLexicon:
    """A name dictionary, shared as a value when it is small enough.

    Its source is read once; the words with their flags are kept in the shared folder.
    The value lives in the session of ``name_words``; use it with tables of that session.
    """

    def __init__(
        self,
        name_words: DataFrame,
        max_shared_bytes: int = MAX_SHARED_BYTES,
        stop_words: Iterable[str] = W.STOP_WORDS,
    ):
        self.spark: SparkSession = name_words.sparkSession
        self.path = scratch_path(self.spark, "lexicon")
        word_flags(name_words, stop_words).write.parquet(self.path)
        self.flags = self.spark.read.schema("word string, flags int").parquet(self.path)
        size = self.flags.agg(
            F.count("*").alias("n"), F.sum(F.octet_length("word") + WORD_OVERHEAD).alias("bytes")
        ).first()
        self.n_words: int = size["n"]
        self.n_bytes: int = size["bytes"] or 0
        self.variable: str | None = self._publish() if self.n_bytes <= max_shared_bytes else None
        self.filter_bits: int = min(MAX_FILTER_BITS, 1 << max(10, (self.n_words * FILTER_BITS_PER_WORD).bit_length()))
        self.filter: str | None = None if self.variable else self._publish_filter()

    def _publish_filter(self) -> str:
        name = f"veil_filter_{uuid.uuid4().hex}"
        self.flags.createOrReplaceTempView(name + "_words")
        self.spark.sql(f"DECLARE OR REPLACE VARIABLE {name} ARRAY<BIGINT>")
        self.spark.sql(
            f"""
            SET VAR {name} = (
              SELECT transform(array_sort(collect_list(struct(slots.id AS id, coalesce(bits, 0L) AS bits))), s -> s.bits)
              FROM range(0, {self.filter_bits // 64}, 1, 8) slots
              LEFT JOIN (
                SELECT place div 64 AS slot, bit_or(shiftleft(1L, cast(place % 64 AS INT))) AS bits
                FROM (SELECT explode(array({", ".join(filter_places("word", self.filter_bits))})) AS place FROM {name}_words)
                GROUP BY place div 64
              ) filled ON slots.id = filled.slot
            )
            """
        )
        self.spark.catalog.dropTempView(name + "_words")
        return name

    def words_to_join(self, text: str) -> str:
        """SQL for the words of a text that the dictionary may list."""
        return perhaps_listed(candidate_words(text), self.filter, self.filter_bits)

    def _publish(self) -> str:
        name = f"veil_lexicon_{uuid.uuid4().hex}"
        n_buckets = max(16, self.n_words // WORDS_PER_BUCKET)
        bucket, digit = f"pmod(xxhash64(word), {n_buckets})", f"substr('{FLAG_DIGITS}', flags + 1, 1)"
        self.flags.createOrReplaceTempView(name + "_words")
        self.spark.sql(f"DECLARE OR REPLACE VARIABLE {name} ARRAY<STRING>")
        self.spark.sql(
            f"""
            SET VAR {name} = (
              SELECT transform(array_sort(collect_list(struct(slots.id AS id, entries))),
                               b -> coalesce(b.entries, '{EDGE}'))
              FROM range(0, {n_buckets}, 1, 8) slots
              LEFT JOIN (
                SELECT {bucket} AS bucket,
                       array_join(collect_list({entry("word", digit)}), '') AS entries
                FROM {name}_words GROUP BY {bucket}
              ) filled ON slots.id = filled.bucket
            )
            """
        )
        self.spark.catalog.dropTempView(name + "_words")
        return name

    def in_session(self, spark: SparkSession) -> NameLexicon:
        """The same dictionary for tables of another session, such as that of a stream's batches."""
        other = copy(self)
        other.spark = spark
        other.flags = spark.read.schema("word string, flags int").parquet(self.path)
        other.variable = other._publish() if self.variable else None
        other.filter = other._publish_filter() if self.filter else None
        return other

    def drop(self) -> None:
        """Forget the shared value and the kept words.  Data frames and functions made with it stay valid until then."""
        if self.variable:
            self.spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {self.variable}")
            self.variable = None
        if self.filter:
            self.spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {self.filter}")
            self.filter = None
        remove_scratch(self.spark, self.path)

    def attach(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """Add column ``name``: the look-up table the text in ``column`` needs."""
        if self.variable:
            return evaluated_once(df, F.expr(needed_words(quoted(column), self.variable)), name)
        return self._attach_joined(df, column, name)

    def _attach_joined(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """The same by a join, keyed by a hash of the text.

        The rows are written once with that key, under plain column names, and read for
        both sides of the join.  Texts that share a hash share a superset of what each
        needs, which changes no look-up.  Words that the filter rules out are left out,
        and equal pairs of text and word are made one, before the first shuffle.  A word that stands in very many texts, and a text with
        very many copies, make skewed joins, which adaptive execution splits by their
        measured sizes.
        """
        plain = [f"c{k}" for k in range(len(df.columns))]
        staged = df.withColumn("__k", F.xxhash64(quoted(column))).toDF(*plain, "k")
        path = scratch_path(self.spark, "texts")
        staged.write.parquet(path)
        staged = self.spark.read.schema(staged.schema).parquet(path)

        text = quoted(plain[df.columns.index(column)])
        pairs = staged.select("k", F.explode(F.expr(self.words_to_join(text))).alias("word")).distinct()
        digit = f"substr('{FLAG_DIGITS}', flags + 1, 1)"
        hit = F.struct(F.xxhash64("word").alias("h"), F.expr(entry("word", digit)).alias("e"))
        needed = (
            pairs.join(self.flags, "word")
            .groupBy("k")
            .agg(F.collect_list(hit).alias("found"))  # words of one text
            .select(F.col("k").alias("j"), F.expr(row_table("found")).alias("found"))
        )
        return (
            staged.join(needed, F.col("k") == F.col("j"), "left")
            .select(*plain, F.coalesce("found", F.array(F.lit(EDGE))))
            .toDF(*df.columns, name)
        )

"""Building name dictionaries from word lists and knowledge-base triples."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions import word_lists as W


def labels_of(triples: DataFrame, classes: Iterable[str], languages: Iterable[str] = W.LABEL_LANGUAGES) -> DataFrame:
    """Distinct labels, in the given languages, of all instances of the given classes.

    The instances are made distinct before the join, so an item that is an instance
    of many classes, or listed many times, meets its labels once.
    """
    instances = triples.filter((F.col("p") == W.INSTANCE_OF) & F.col("o").isin(*classes)).select("s").distinct()
    labels = triples.filter((F.col("p") == W.LABEL) & F.col("lang").isin(*languages)).select("s", "o").distinct()
    return labels.join(instances, "s", "left_semi").select(F.col("o").alias("word")).distinct()


def word_forms(
    triples: DataFrame, languages: Iterable[str] = W.LEXEME_LANGUAGES, excluded: str = W.PROPER_NOUN
) -> DataFrame:
    """Distinct written forms of the lexemes of the given languages, proper nouns left out."""

    def edges(predicate: str, subject: str, obj: str) -> DataFrame:
        return triples.filter(F.col("p") == predicate).select(F.col("s").alias(subject), F.col("o").alias(obj))

    of_language = edges(W.LANGUAGE, "lexeme", "lang").filter(F.col("lang").isin(*languages)).select("lexeme").distinct()
    of_category = edges(W.CATEGORY, "lexeme", "category").filter(F.col("category") != excluded)
    kept = of_category.select("lexeme").distinct().join(of_language, "lexeme", "left_semi")
    forms = edges(W.FORM, "lexeme", "form").distinct().join(kept, "lexeme", "left_semi").select("form").distinct()
    written = edges(W.REPRESENTATION, "form", "word").distinct()
    return written.join(forms, "form", "left_semi").select("word").distinct()


def is_name_word(word: Column) -> Column:
    """A capitalised word of two or more letters; hyphens, apostrophes and the inner
    capital of names such as McDonald are allowed."""

    def part_ok(part: Column) -> Column:
        letters = F.regexp_replace(part, "['’]", "")
        lower_rest = F.rlike(letters, F.lit(r"(?U)^.[^\p{Upper}\p{Lt}]*\p{Lower}[^\p{Upper}\p{Lt}]*\z"))
        prefixed = reduce(lambda a, b: a | b, (F.startswith(part, F.lit(p)) for p in W.INNER_CAPITAL_PREFIXES))
        return (
            F.rlike(part, F.lit(r"(?U)^\p{Upper}"))
            & F.rlike(letters, F.lit(r"^\p{L}+\z"))
            & (lower_rest | prefixed)
        )

    return (F.char_length(word) >= 2) & F.forall(F.split(word, "-"), part_ok)


def name_words_only(words: DataFrame) -> DataFrame:
    """The distinct words that can be names."""
    return words.filter(is_name_word(F.col("word"))).select("word").distinct()


def ordinary_words(forms: DataFrame, places: DataFrame) -> DataFrame:
    """Word forms and place names together, each once."""
    return forms.select("word").union(places.select("word")).distinct()


def ambiguous_names(given: DataFrame, surnames: DataFrame, words: DataFrame, known: Iterable[str] = W.KNOWN_NAMES):
    """Names that are also words, as written or in lower case, and not well-known names.

    Two equi-joins instead of one with OR, which could only run as a nested loop.
    """
    names = given.select("word").union(surnames.select("word")).distinct()
    names = names.filter(~F.col("word").isin(*known))
    as_written = names.join(words, "word", "left_semi")
    lowered = names.withColumn("lower", F.lower("word")).join(
        words.select(F.col("word").alias("lower")), "lower", "left_semi"
    )
    return as_written.union(lowered.select("word")).distinct()


def stop_list(spark: SparkSession) -> DataFrame:
    """The built-in stop words."""
    return spark.createDataFrame([(word,) for word in W.STOP_WORDS], "word string")


def merge_lists(
    given: DataFrame, surnames: DataFrame, ambiguous: DataFrame, stop_words: DataFrame | None = None
) -> DataFrame:
    """The four lists as one table ``name_words``, one row per word; the stop list is the built-in one by default."""
    if stop_words is None:
        stop_words = stop_list(given.sparkSession)
    names = ("is_given", "is_surname", "is_ambiguous", "is_stop")
    parts = [
        df.select("word", *[F.lit(name == flag).alias(flag) for flag in names])
        for name, df in zip(names, (given, surnames, ambiguous, stop_words), strict=True)
    ]
    merged = reduce(DataFrame.union, parts).groupBy("word")
    return merged.agg(*[F.bool_or(flag).alias(flag) for flag in names])


def list_counts(name_words: DataFrame) -> DataFrame:
    """How many words each list holds."""
    lists = {"given_names": "is_given", "surnames": "is_surname", "ambiguous_names": "is_ambiguous"}
    counts = name_words.agg(*[F.count_if(flag).alias(name) for name, flag in lists.items()])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("list"), F.col(n).alias("n_words")) for n in lists]))
    )

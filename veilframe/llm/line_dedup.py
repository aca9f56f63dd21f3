"""Delete repeated runs of lines.

A truncated suffix array over the sequences of line ids, built by prefix doubling: the rank of
a place is the number of suffixes that sort before it, seen to a depth; the ranks of two
places ``depth`` apart give the rank to twice the depth.  A place whose rank nobody shares
can't start a repeat and is discarded, so later rounds see only repeated lines.  Places of
equal rank at depth ``min_lines`` are the intervals of the array whose common prefix is that
long; all but the first place of an interval are later copies, and overlapping copies join to
maximal runs.  The array is truncated at that depth: longer common prefixes aren't computed.

With ``min_words`` a run of fewer lines counts too if it has more words than that; then the depth
grows line by line, and the ranks at each smaller depth give these.  With ``whole_texts`` rows of equal
text are one for them: all lose what the first of them loses, and dropping copies of whole texts is
left to others.

Line ids are 128 bits of hash.  Lines end at ``\\n``.  "First" goes by document id, then by a
hash of the text, then by line.

Defined cases: a null text stays null and has no lines; an empty text is one empty line; rows
equal in id and text are one row for the search and get the same result each; null ids come
first; an empty table gives no row; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.shared import fresh, row_key, running_total, stored, word_count

#: Lines that a repeated run has at least, and words from which on, one more, it may have fewer lines.
MIN_LINES, MIN_WORDS = 3, 50
PLACE = ["key_id", "key_hash", "pos"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def ranked(places: DataFrame, by: list[str], *more: str) -> DataFrame:
    """``places`` that share ``by`` with another, with their rank instead of it, and the columns ``more``."""
    groups = places.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")
    ranks = running_total(groups, by, "n", "smaller").select(*by, "smaller")
    return places.join(ranks, by).select(*PLACE, F.col("smaller").alias("rank"), *more)


def rounds(docs: DataFrame, min_lines: int, words: bool) -> Iterator[tuple[int, DataFrame]]:
    """Depths up to ``min_lines``, each with its places (key_id, key_hash, pos, rank) that share so many lines with others.

    With ``words`` all depths, and the places have ``line_words`` (of their line) and ``run_words`` (to the depth).
    """
    text, counts = F.col("text"), ["line_words", "run_words"] if words else []
    lines = docs.where(text.isNotNull()).select(*row_key(F.col("doc_id"), text), F.posexplode(lines_of(text)).alias("pos", "line"))
    ids = lines.select(*PLACE, F.xxhash64(F.lit(1), "line").alias("a"), F.xxhash64(F.lit(2), "line").alias("b"), *[word_count(F.col("line")).alias(c) for c in counts])
    active, depth = stored(ranked(ids, ["a", "b"], *counts).dropDuplicates(PLACE), "ranks"), 1
    yield depth, active
    while depth < min_lines:
        step = 1 if words else min(depth, min_lines - depth)
        ahead = active.select("key_id", "key_hash", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"), *[F.col(c).alias("rest_words") for c in counts[1:]])
        both = active.join(ahead, PLACE)
        if words:
            both = both.withColumn("run_words", F.col("line_words") + F.col("rest_words"))
        active, depth = stored(ranked(both, ["rank", "next"], *counts), "ranks"), depth + step
        yield depth, active


def suffix_intervals(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """key_id, key_hash, pos, rank: places that share ``min_lines`` lines with others of their rank."""
    *_, (_, active) = rounds(docs, min_lines, words=False)
    return active


def later_places(places: DataFrame) -> DataFrame:
    """All places but the first of each rank."""
    first = places.groupBy("rank").agg(F.min(F.struct(*PLACE)).alias("first"))
    return places.join(first, "rank").where(F.struct(*PLACE) != F.col("first"))


def wordy_copies(places: DataFrame, depth: int, min_words: int, whole_texts: bool) -> DataFrame:
    """key_id, key_hash, start, end (exclusive): runs of ``depth`` lines and more than ``min_words`` words that are later copies."""
    long = places.where(F.col("run_words") > min_words).select(*PLACE, "rank")
    if not whole_texts:
        return later_places(long).select("key_id", "key_hash", F.col("pos").alias("start"), (F.col("pos") + depth).alias("end"))
    owners = long.groupBy(F.col("key_hash").alias("text_hash")).agg(F.min("key_id").alias("owner"))  # the first row of each text
    owned = long.join(owners, F.col("key_hash") == F.col("text_hash"))
    place = F.struct("owner", "key_hash", "pos")
    first = owned.groupBy("rank").agg(F.min(place).alias("first"))
    later = owned.join(first, "rank").where(place != F.col("first"))
    return later.select("key_id", "key_hash", F.col("pos").alias("start"), (F.col("pos") + depth).alias("end"))


def later_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None, whole_texts: bool = False) -> DataFrame:
    """key_id, key_hash, start, end (exclusive): maximal runs of lines that are later copies.

    With ``min_words`` also shorter runs of more words; these may overlap the others.
    """
    *shorter, (_, places) = rounds(docs, min_lines, min_words is not None)
    later = later_places(places)
    doc = Window.partitionBy("key_id", "key_hash").orderBy("pos")
    apart = F.coalesce(F.col("pos") > F.lag("pos").over(doc) + min_lines, F.lit(True))
    runs = later.select(*PLACE, apart.cast("int").alias("new")).withColumn("run", F.sum("new").over(doc))
    runs = runs.groupBy("key_id", "key_hash", "run").agg(F.min("pos").alias("start"), (F.max("pos") + min_lines).alias("end")).drop("run")
    for depth, short in shorter if min_words is not None else []:
        runs = runs.union(wordy_copies(short, depth, min_words, whole_texts))
    return runs


def dedup_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, counts: tuple[str, str] | None = None, min_words: int | None = None, whole_texts: bool = False
) -> DataFrame:
    """``docs`` with the later runs taken out of ``text``.

    ``counts`` names two more columns, for the lines before and for those deleted.
    """
    runs = later_runs(docs, min_lines, min_words, whole_texts).groupBy("key_id", "key_hash").agg(F.collect_list(F.struct("start", "end")).alias("r"))
    i, h, j, k, cut, kept = fresh(docs, "row_id", "row_hash", "join_id", "join_hash", "cut_runs", "kept_lines")
    key_id, key_hash = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumns({i: key_id, h: key_hash})
    runs = runs.toDF(j, k, cut)
    lines = lines_of(F.col("text"))
    inside = lambda n: F.exists(cut, lambda r: (n >= r["start"]) & (n < r["end"]))
    both = keyed.join(runs, (F.col(i) == F.col(j)) & (F.col(h) == F.col(k)), "left")
    both = both.withColumn(kept, F.when(F.col(cut).isNotNull(), F.filter(lines, lambda _, n: ~inside(n))))
    extra = []
    if counts:
        total = F.coalesce(F.size(lines), F.lit(0)).cast("long")
        total = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(total)
        gone = F.when(F.col(cut).isNull(), F.lit(0).cast("long")).otherwise(total - F.size(kept))
        extra = [total.alias(counts[0]), gone.alias(counts[1])]
    text = F.coalesce(F.array_join(kept, "\n"), F.col("text")).alias("text")
    return both.select(*[text if c == "text" else F.col(f"`{c}`") for c in docs.columns], *extra)

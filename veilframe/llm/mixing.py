"""Mix sources to target weights by nested hash thresholds.

Each row has a hash that does not depend on the run.  The words of a source are summed by
hash bucket; the buckets below the threshold are taken whole, and only the bucket on the
boundary is split again by the next bits of the hash, until its rows agree in all bits.
No row is ever sorted.

Defined cases: a null text has no words; a null source is a source of its own, ordered last;
a row without words is taken 0 times; rows equal in id and text share their hash and are taken
together; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.shared import row_key, stored, word_count

#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (5, 2, 1)
#: All targets together, and the most a source or a row may give, as a multiple of its words.
SHARE, MOST = 1.5, 2
#: Bits of the hash that one round of histograms resolves, and all bits of it.
STEP, BITS = 12, 60


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text, as long; the same in every engine."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target from ``sizes`` (source, source_size), one row a source.

    Sharing the excess again and again ends where every source has either its limit or the
    same multiple of its weight.  With the sources in the order of limit by weight, the ones
    at their limit come first, so running sums give the multiple for each possible number of
    them and the first that leaves no one above is the answer.  Only this small table of
    sources is ordered as a whole.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    limits = sizes.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    up_to = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, whole = up_to.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    multiple = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    tried = limits.withColumn("multiple", multiple)
    fits = F.col("multiple") * F.col("weight") <= F.col("cap")
    level = F.first(F.when(fits, F.col("multiple")), ignorenulls=True).over(
        up_to.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return tried.withColumn("level", level).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """key_id, key_hash, doc_id, size, source, source_size, target, taken, one row for each of ``docs``.

    ``taken`` is size times the number of copies: a source above its own size gives every row
    whole, then the rows below the threshold once more.
    """
    rows = docs.select(
        *row_key(F.col("doc_id"), F.col("text")),
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        hash_of(F.col("doc_id"), F.col("text")).alias("hash"),
    )
    rows = stored(rows, "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long"))
    targets = stored(targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")

    # below: first bucket not taken whole; rest: what is still wanted from inside it
    limits = targets.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("below"), "rest")
    same = F.col("source").eqNullSafe(F.col("s"))
    for shift in range(BITS - STEP, -1, -STEP):
        bucket = F.shiftright("hash", shift)
        inside = F.shiftright("hash", shift + STEP) == F.col("below")
        sums = rows.where("size > 0").join(limits, same).where(inside).groupBy("s", "rest", bucket.alias("bucket"))
        sums = sums.agg(F.sum("size").alias("words"))
        until = F.sum("words").over(Window.partitionBy("s").orderBy("bucket"))
        sums = sums.withColumn("over", until > F.col("rest")).withColumn("until", until)
        found = sums.groupBy("s").agg(
            F.min(F.when(F.col("over"), F.col("bucket"))).alias("first"),
            F.max("bucket").alias("last"),
            F.max("rest").alias("rest"),
            F.coalesce(F.max(F.when(~F.col("over"), F.col("until"))), F.lit(0)).alias("took"),
        )
        limits = stored(
            found.select(
                "s",
                F.coalesce("first", F.col("last") + 1).alias("below"),
                (F.col("rest") - F.col("took")).alias("rest"),
            ),
            "limits",
        )
    # the last bucket holds the rows of one hash: take them if that comes nearer to the target
    edge = rows.join(limits, same).where(F.col("hash") == F.col("below")).groupBy("s", "below", "rest")
    edge = edge.agg(F.sum("size").alias("words"))
    edge = edge.select(F.col("s").alias("e"), (F.col("words") <= 2 * F.col("rest")).alias("near"))
    limits = limits.join(edge, F.col("s").eqNullSafe(F.col("e")), "left")
    limits = limits.select("s", (F.col("below") + F.coalesce(F.col("near"), F.lit(False)).cast("long")).alias("below"))
    shares = stored(targets.join(limits, same, "left").drop("s").withColumnRenamed("source", "t"), "shares")
    again = (F.col("hash") < F.coalesce("below", F.lit(0))).cast("long")
    taken = F.col("size") * (F.col("whole") + again)
    return rows.join(shares, F.col("source").eqNullSafe(F.col("t"))).select(
        "key_id", "key_hash", "doc_id", "size", "source", "source_size", "target", taken.alias("taken")
    )

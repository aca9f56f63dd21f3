"""Exact distinct counts over rollup levels, from bitmaps that merge upwards.

``count(DISTINCT)`` under ROLLUP copies each row once for each level.  Here rows are read once:
each finest group gets bitmaps of the values it holds (one for each 32,768 values, so a task
aggregates before anything is shuffled), and each level above merges those of the level below.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.session import written


def rollup_distinct(df: DataFrame, levels: list[str], value: str, name: str = "n_distinct") -> DataFrame:
    """``levels``, grouping_level, ``name``: the distinct values of each group, as ``count(DISTINCT value)`` under ``ROLLUP(levels)``.

    grouping_level is how many of the levels are rolled up (they are null in the row).  ``value`` is a
    whole number; nulls aren't counted, but their group has a row.  Null is a group like any
    other.  An empty table gives the total row alone, as ROLLUP does.
    """
    if df.schema[value].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{value} is no whole number; number its values first")
    number = F.col(value).cast("long")
    finest = df.groupBy(*levels, F.bitmap_bucket_number(number).alias("bitmap_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce(number, F.lit(0)))).alias("bitmap_bits")
    )
    merged, out = written(finest, "bitmaps"), []
    for k in range(len(levels), -1, -1):
        if k < len(levels):
            merged = merged.groupBy(*levels[:k], "bitmap_part").agg(F.bitmap_or_agg("bitmap_bits").alias("bitmap_bits"))
            merged = written(merged, "bitmaps") if k else merged
        counts = F.coalesce(F.sum(F.when(F.col("bitmap_part").isNotNull(), F.bitmap_count("bitmap_bits"))), F.lit(0)).alias(name)
        counted = merged.groupBy(*levels[:k]).agg(counts)
        rolled = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in levels[k:]]
        out.append(counted.select(*levels[:k], *rolled, F.lit(len(levels) - k).alias("grouping_level"), name))
    return reduce(DataFrame.union, out)

"""Running totals, sliding time frames and one-sided inequality joins over groups of any size.

A window whose group is a hot key, or the whole table, is one task.  Here rows are dealt by
range of (key, order), so a large group spreads over many partitions; each partition counts by
itself and adds what the partitions before it hold of its first key.  That takes a table of
two rows a partition.  The order has to tell rows apart as far as a group is to be split:
rows equal in key and order stay together.

Defined cases: a null key is a group of its own; nulls of the order come first; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.session import written

_PART = "ordered_part"


def _dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(n, *keys, *order).withColumn(_PART, F.spark_partition_id()), "ordered")


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with a column for each of ``sums``: its total over the rows of the same ``keys`` up to this one, in the order of ``order``.

    Amounts are whole numbers or decimals; null counts as 0.  With no keys the group is the whole table.
    """
    amounts = {f"ordered_amount_{k}": F.coalesce(amount, F.lit(0)) for k, amount in enumerate(sums.values())}
    dealt = _dealt(df.withColumns(amounts), keys, order)
    totals = dealt.groupBy(_PART, *keys).agg(*[F.sum(a).alias(a) for a in amounts])
    if keys:  # only the first and the last key of a partition can go on in another one
        ends = totals.groupBy(_PART).agg(F.min(F.struct(*keys)).alias("low"), F.max(F.struct(*keys)).alias("high"))
        key = F.struct(*[F.col(f"t.{k}").alias(k) for k in keys])
        edge = key.eqNullSafe(F.col("e.low")) | key.eqNullSafe(F.col("e.high"))
        totals = totals.alias("t").join(ends.alias("e"), F.col(f"t.{_PART}") == F.col(f"e.{_PART}")).where(edge).select("t.*")
    same = [F.col(k) for k in keys] or [F.col(_PART) < 0]  # without keys all partitions' rows are one group, one row each
    earlier = Window.partitionBy(*same).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col(_PART).alias("ordered_p"),
        *[F.col(k).alias(f"ordered_key_{i}") for i, k in enumerate(keys)],
        *[F.sum(a).over(earlier).alias(f"{a}_before") for a in amounts],
    )
    on = F.col(_PART) == F.col("ordered_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"ordered_key_{i}"))
    inside = Window.partitionBy(_PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = dealt.join(F.broadcast(before), on, "left")  # at most two rows a partition
    for (name, _), amount in zip(sums.items(), amounts, strict=True):
        both = both.withColumn(name, F.coalesce(F.col(f"{amount}_before"), F.lit(0)) + F.sum(amount).over(inside))
    return both.select(*[f"`{c}`" for c in df.columns], *[f"`{name}`" for name in sums])


def sliding_sums(df: DataFrame, keys: list[str], time: str, length: str, sums: dict[str, Column]) -> DataFrame:
    """``df`` with totals over the rows of the same ``keys`` whose ``time`` lies within ``length`` (an interval) before this row's, or at it.

    As ``RANGE BETWEEN INTERVAL length PRECEDING AND CURRENT ROW``: rows of one time see each
    other, rows without time see only those without.  Rows of one key and time are summed first.
    Each sum then comes in at its time and leaves after the interval, so a running sum over both
    kinds of steps is the sliding one; no row is copied to a neighbour, and a hot key is split by time.
    """
    at = [*keys, time]
    summed = df.groupBy(*at).agg(*[F.sum(F.coalesce(a, F.lit(0))).alias(name) for name, a in sums.items()])
    summed = written(summed, "sliding")
    comes = summed.where(F.col(time).isNotNull()).withColumn("ordered_step", F.lit(0))
    leaves = comes.withColumns({time: F.col(time) + F.expr(f"INTERVAL {length}"), "ordered_step": F.lit(1), **{n: -F.col(n) for n in sums}})
    totals = {f"ordered_total_{k}": F.col(n) for k, n in enumerate(sums)}
    run = running_sums(comes.unionByName(leaves), keys, [time, "ordered_step"], totals).where("ordered_step = 0")
    names = [f"ordered_at_{k}" for k in range(len(at))]
    found = run.select(*at, *totals).union(summed.where(F.col(time).isNull()).select(*at, *sums)).toDF(*names, *totals)
    on = F.lit(True)
    for column, name in zip(at, names, strict=True):
        on = on & F.col(column).eqNullSafe(F.col(name))
    return df.join(found, on).select(*[f"`{c}`" for c in df.columns], *[F.col(t).alias(n) for t, n in zip(totals, sums, strict=True)])


def sums_below(probes: DataFrame, others: DataFrame, keys: list[str], value: str, sums: dict[str, Column], equal: bool = False) -> DataFrame:
    """The distinct (keys, value) of ``probes``, with totals over ``others`` of the same keys and a smaller ``value`` (or the same, if ``equal``).

    That is the join on ``others.value < probes.value`` and the aggregate over its pairs, without
    the pairs: both sides are merged in order once.  Null keys match nothing; a null value, on either side, neither.
    """
    at = [*keys, value]
    counted = others.dropna(subset=at).groupBy(*at).agg(*[F.sum(F.coalesce(a, F.lit(0))).alias(n) for n, a in sums.items()])
    wanted = probes.select(*at).distinct().withColumn("ordered_probe", F.lit(True))
    first = F.lit(0 if equal else 1)
    steps = counted.withColumns({"ordered_step": first, "ordered_probe": F.lit(False)}).unionByName(
        wanted.dropna(subset=at).withColumn("ordered_step", 1 - first), allowMissingColumns=True
    )
    totals = {f"ordered_total_{k}": F.col(n) for k, n in enumerate(sums)}
    run = running_sums(steps, keys, [value, "ordered_step"], totals).where("ordered_probe")
    none = wanted.where(" OR ".join(f"`{c}` IS NULL" for c in at)).select(*at, *[F.lit(0).cast(run.schema[t].dataType).alias(t) for t in totals])
    return run.select(*at, *totals).union(none).toDF(*at, *sums)

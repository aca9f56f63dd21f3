"""Running totals, sliding frames, inequality joins, distinct counts and requests against plain readings."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilframe.operators.conversations import conversation_requests
from veilframe.operators.distinct_counts import rollup_distinct
from veilframe.operators.ordered import running_sums, sliding_sums, sums_below

START = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def events(spark):
    """One user, and null users, hold most rows; many of them have no time, many times are shared."""
    rng, rows = random.Random(4), []
    for k in range(3000):
        user = rng.choice([1, 1, 1, None, rng.randint(2, 40)])
        ts = None if rng.random() < 0.3 else START + timedelta(hours=rng.randint(0, 24 * 40))
        rows.append((k, user, ts, rng.choice([None, *range(-5, 30)])))
    return rows, spark.createDataFrame(rows, "id int, user int, ts timestamp, v int").cache()


@pytest.mark.parametrize("keys", [[], ["user"]])
def test_running_sums(events, keys):
    rows, df = events
    out = running_sums(df, keys, ["ts", "id"], {"n": F.lit(1), "total": F.col("v")})
    counts, expected = defaultdict(lambda: [0, 0]), {}
    for i, user, ts, v in sorted(rows, key=lambda r: (r[2] is not None, r[2] or START, r[0])):
        state = counts[user if keys else 0]
        state[0] += 1
        state[1] += v or 0
        expected[i] = tuple(state)
    assert {r.id: (r.n, r.total) for r in out.collect()} == expected
    assert "SinglePartition" not in plan_of(out)
    spread = running_sums(df.where("user = 1"), ["user"], ["ts", "id"], {"n": F.lit(1)})
    dealt = spread.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(dealt) > 1  # one hot key, a third of it without time, lies in several partitions
    assert running_sums(df.limit(0), keys, ["ts", "id"], {"n": F.lit(1)}).collect() == []


def test_sliding_sums(events):
    rows, df = events
    out = sliding_sums(df, ["user"], "ts", "3 DAYS", {"n": F.lit(1), "total": F.col("v")})
    by_user = defaultdict(list)
    for r in rows:
        by_user[r[1]].append(r)
    expected = {}
    for i, user, ts, _ in rows:
        seen = [r[3] or 0 for r in by_user[user] if (r[2] is None if ts is None else r[2] is not None and ts - timedelta(days=3) <= r[2] <= ts)]
        expected[i] = (len(seen), sum(seen))
    assert {r.id: (r.n, r.total) for r in out.collect()} == expected and out.columns == ["id", "user", "ts", "v", "n", "total"]
    whole = sliding_sums(df, [], "ts", "3 DAYS", {"n": F.lit(1)})
    times = [r[2] for r in rows]
    assert {r.id: r.n for r in whole.collect()} == {
        i: sum(t is None if ts is None else t is not None and ts - timedelta(days=3) <= t <= ts for t in times) for i, _, ts, _ in rows
    }


@pytest.mark.parametrize("equal", [False, True])
def test_sums_below(spark, events, equal):
    rows, df = events
    others = df.where("id % 3 = 0").select("user", F.col("v"), "id")
    out = sums_below(df, others, ["user"], "v", {"n": F.lit(1), "total": F.col("id")}, equal)
    expected = {}
    for user, v in {(r[1], r[3]) for r in rows}:
        below = [r[0] for r in rows if r[0] % 3 == 0 and None not in (user, v, r[3]) and r[1] == user and (r[3] < v or equal and r[3] == v)]
        expected[user, v] = (len(below), sum(below))
    assert {(r.user, r.v): (r.n, r.total) for r in out.collect()} == expected
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)


def test_rollup_distinct(spark, events):
    rows, df = events
    df = df.select("user", (F.col("id") % 7).alias("kind"), F.when(F.col("v") > -3, F.col("v") * 40_000).alias("value"))
    for levels in (["kind", "user"], ["user"], []):
        out = rollup_distinct(df, levels, "value")
        expected = df.rollup(*levels).agg(F.grouping_id().alias("g"), F.count_distinct("value").alias("n")) if levels else df.agg(F.count_distinct("value").alias("n"))
        plain = {(*[r[c] for c in levels], r["g"].bit_count() if levels else 0): r["n"] for r in expected.collect()}
        assert {(*[r[c] for c in levels], r.grouping_level): r.n_distinct for r in out.collect()} == plain
        assert "Expand" not in plan_of(out)
    assert [tuple(r) for r in rollup_distinct(df.limit(0), ["kind"], "value").collect()] == [(None, 1, 0)]
    with pytest.raises(TypeError):
        rollup_distinct(df.withColumn("value", F.lit("x")), ["kind"], "value")


@pytest.mark.parametrize("part", [1 << 24, 300])
def test_conversations(spark, part):
    rng = random.Random(6)
    rows = [(1, k, rng.choice(["user", "assistant"]), f'"{k}" ü\n' * rng.randint(0, 5)) for k in range(200)]  # a long one
    rows += [(None, 0, "user", "hi"), (None, None, None, None), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, None, "system", "first"), (3, 5, "user", None), (2, 1, "user", "a")]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "conv_id int, turn int, role string, text string")
    out = conversation_requests(df, 'a "model"', "conv_id", ["turn"], part=part).orderBy("part").collect()
    texts, turns = defaultdict(str), defaultdict(int)
    for r in out:
        texts[r.conv_id] += r.request
        turns[r.conv_id] += r.n_turns
        assert len(r.request) <= part + 200
    assert turns == {1: 200, None: 2, 2: 4, 3: 1} and (len(out) == 4) == (part > 300)
    for chat, text in texts.items():
        request = json.loads(text)
        assert request["model"] == 'a "model"'
        expected = sorted((r for r in rows if r[0] == chat), key=lambda r: (r[1] is not None, r[1] or 0, r[3] or ""))
        assert [(m["role"], m["content"]) for m in request["messages"]] == [(r[2] or "", r[3] or "") for r in expected]
    assert conversation_requests(df.limit(0), "m", "conv_id", ["turn"]).collect() == []

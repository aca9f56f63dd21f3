"""Near-duplicates by SimHash, found with the generalised pigeonhole principle.

The 64 bits are split into parts that hold correlated bits together.  If the thresholds of
``m`` parts sum to the distance less ``m`` - 1, two fingerprints within the distance agree in
some part up to its threshold.  How many parts, and which threshold for each (-1: not
probed), is chosen by dynamic programming on the estimated number of candidates and probes,
from counts over all fingerprints.  A part with threshold ``t`` is probed by its value with
any ``t`` of its bits blanked, so fingerprints that differ in up to ``t`` of them meet under a
key.  Whoever meets is compared; links are the pairs within the distance.

Defined cases: a null or empty text has no words and the fingerprint zero, which links like any
other; equal fingerprints are one node, so copies are never paired; a null id is passed on, and
ignored for the smallest id unless a class has no other; an empty table gives no row; other
columns are kept by ``near_duplicates`` only where it says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.components import components
from veilframe.llm.shared import partitions, stored

WIDTH, SEED = 64, 42
#: Words of a shingle, and bits in which linked fingerprints differ at most.
SHINGLE, DISTANCE = 3, 3
#: Shingles hashed at a time, so that a long text needs no more memory than a short one.
CHUNK = 1 << 16
#: Numbers of parts that are tried, and the price of a probe in comparisons.
PARTS, PROBE = (2, 3, 4), 8.0
#: Rows of a bucket that are compared in one task; a larger bucket is cut into pairs of blocks.
BLOCK = 4096
#: Buckets up to this size report all links, larger ones a spanning forest.
ALL_LINKS = 32


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned; words are lower-cased in A-Z only, all shingles count as often as they stand."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    count, ones = max(1, len(words) - size + 1), np.zeros(WIDTH, np.int64)
    for start in range(0, count, CHUNK):
        some = words[start : min(start + CHUNK, count) + size - 1]
        grams = map(b" ".join, zip(*[some[k:] for k in range(size)], strict=False)) if len(words) >= size else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp``: the fingerprint's bits as a long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn("fp", of("text"))


def hex_digits(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << WIDTH) if mask >> (WIDTH - 1) else mask


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bits of each pair set.

    Every task sends its 64 x 64 sums; only their total comes to the driver.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((WIDTH, WIDTH)), 0
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy()).astype(np.float32)
            total, n = total + bits.T @ bits, n + len(bits)
        yield pd.DataFrame({"cell": np.arange(-1, WIDTH * WIDTH), "value": np.concatenate([[n], total.ravel()])})

    rows = fps.select("fp").mapInPandas(sums, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    cells = np.zeros(WIDTH * WIDTH + 1)
    for r in rows:
        cells[r["cell"] + 1] = r["value"]
    return int(cells[0]), cells[1:].reshape(WIDTH, WIDTH)


def correlated_parts(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The bits in ``m`` parts of near equal width, each grown by the bit most correlated with it."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    tied = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    left, parts = set(range(WIDTH)), []
    for k in range(m):
        part = [max(sorted(left), key=lambda b: tied[b, sorted(left)].sum())]
        left.remove(part[0])
        while len(part) < WIDTH // m + (k < WIDTH % m):
            part.append(max(sorted(left), key=lambda b: tied[b, part].sum()))
            left.remove(part[-1])
        parts.append(sorted(part))
    return parts


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one a part, with the given sum and the least cost; dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for done, (spent, chosen) in best.items():
            for t, c in cost.items():
                if done + t not in following or spent + c < following[done + t][0]:
                    following[done + t] = (spent + c, [*chosen, t])
        best = following
    return best[total]


def plan_masks(fps: DataFrame, distance: int = DISTANCE) -> list[int]:
    """The masks under which fingerprints within ``distance`` are sure to meet.

    Pairs that agree in a whole part are counted over all fingerprints; how many more agree
    but for a few bits is estimated from the share of ones of those bits.
    """
    n, both = bit_counts(fps)
    plans = [correlated_parts(n, both, m) for m in PARTS]
    keys = [(p, k, sum(1 << b for b in part)) for p, parts in enumerate(plans) for k, part in enumerate(parts)]
    by_key = F.array(*[F.struct(F.lit(p * 8 + k).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value")) for p, k, mask in keys])
    sizes = fps.select(F.explode(by_key).alias("key")).groupBy("key.part", "key.value").agg(F.count("*").alias("c"))
    pairs = {r["part"]: r["pairs"] for r in sizes.groupBy("part").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).collect()}
    share = np.diag(both) / max(n, 1)
    agree = np.clip(share**2 + (1 - share) ** 2, 1e-6, 1)
    best = (float("inf"), [])
    for p, parts in enumerate(plans):
        costs = []
        for k, part in enumerate(parts):
            more, cost = [1.0] + [0.0] * distance, {-1: 0.0}
            for b in part:  # elementary symmetric sums of the odds that one bit differs
                more = [more[0]] + [more[d] + more[d - 1] * (1 / agree[b] - 1) for d in range(1, distance + 1)]
            for t in range(distance + 1):
                cost[t] = pairs.get(p * 8 + k, 0.0) * sum(more[: t + 1]) + PROBE * max(n, 1) * comb(len(part), t)
            costs.append(cost)
        spent, chosen = allocate(costs, distance - len(parts) + 1)
        if spent < best[0]:
            best = spent, [sum(1 << b for b in part if b not in blank) for part, t in zip(parts, chosen, strict=True) if t >= 0 for blank in combinations(part, t)]
    return best[1]


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits; of signed numbers, numpy would count those of the absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _within(groups: np.ndarray, fps: np.ndarray, distance: int) -> tuple[list, list]:
    """Links among the rows of each group; rows of a group stand together."""
    a, b = [], []
    edges = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])
    sizes = np.diff(edges)
    few = np.repeat(sizes <= ALL_LINKS, sizes)
    at, d = np.flatnonzero(few), 1
    while len(at):
        at = at[at + d < len(groups)]
        at = at[groups[at] == groups[at + d]]
        near = at[_differing(fps[at], fps[at + d]) <= distance]
        a.append(fps[near])
        b.append(fps[near + d])
        d += 1
    for k in np.flatnonzero(sizes > ALL_LINKS):  # each row joins the first tree that reaches it
        left = np.unique(fps[edges[k] : edges[k + 1]])
        while len(left):
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                near = _differing(left, one := reached.pop()) <= distance
                found, left = left[near], left[~near]
                a.append(np.full(len(found), one))
                b.append(found)
                reached.extend(found)
    return a, b


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: links whose components are those of all pairs of ``fps`` (fp, distinct) within ``distance``."""
    masks = plan_masks(fps, distance)
    keys = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for k, m in enumerate(masks)])
    probes = fps.select("fp", F.explode(keys).alias("key")).select("key.*", "fp")
    sizes = probes.groupBy(F.col("mask").alias("k"), F.col("value").alias("v")).agg(F.count("*").alias("c")).where(f"c > {BLOCK}")
    sizes = sizes.select("k", "v", F.ceil(F.col("c") / BLOCK).cast("long").alias("blocks"))
    cut = probes.join(sizes, (F.col("mask") == F.col("k")) & (F.col("value") == F.col("v")), "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1)))
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    dealt = cut.select("mask", "value", F.explode(tiles).alias("tile"), "fp").select("mask", "value", "tile.*", "fp")
    group = ["mask", "value", "x", "y"]
    dealt = dealt.repartition(partitions(fps.sparkSession), *group).sortWithinPartitions(*group)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(batch):
                continue
            columns = [batch[c].to_numpy() for c in group]
            new = np.r_[False, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]
            groups = np.cumsum(new)
            held = batch[groups == groups[-1]]  # may go on in the next batch; at most two blocks
            done = groups < groups[-1]
            yield _table(*_within(groups[done], batch["fp"].to_numpy()[done], distance))
        if held is not None and len(held):
            yield _table(*_within(np.zeros(len(held), int), held["fp"].to_numpy(), distance))

    return dealt.mapInPandas(compare, "a long, b long").distinct()


def _table(a: list, b: list) -> pd.DataFrame:
    none = [np.empty(0, np.int64)]
    return pd.DataFrame({"a": np.concatenate(a + none).astype(np.int64), "b": np.concatenate(b + none).astype(np.int64)})


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` without ``text``, with ``fp``, ``component`` (names the class) and ``component_id`` (smallest doc_id reachable by links)."""
    rows = stored(fingerprints(docs, size).drop("text"), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    classes = components(links(fps.select("fp"), distance)).select(F.col("node").alias("n"), "component")
    named = fps.join(classes, F.col("fp") == F.col("n"), "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    named = stored(named, "classes")
    least = named.groupBy(F.col("component").alias("c")).agg(F.min("first").alias("component_id"))
    by_fp = named.join(least, F.col("component") == F.col("c")).select(F.col("fp").alias("f"), "component", "component_id")
    return rows.join(by_fp, F.col("fp") == F.col("f")).drop("f")

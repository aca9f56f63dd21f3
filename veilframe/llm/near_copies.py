"""Classes of near copies: texts whose sets of word shingles have a Jaccard coefficient of ``ALIKE`` or more.

Candidates come from MinHash: ``BANDS`` bands of ``ROWS`` smallest hashes; two sets that are
``ALIKE`` share no band in 0.0003 % of cases, and no candidate is taken unless its two whole sets
are compared.  (Five-word SimHash fingerprints of such pairs differ by 4 to 14 of 64 bits at sf0.1; a distance
of 14 leaves the pigeonhole principle parts too short, and probes too many.)  Equal sets are one node, so copies are never paired.

A bucket (sets that share a band) is first compared with its smallest node only.  Where its
sets are of one class after that, nothing is left to find in it.  In all other buckets all nodes
are compared until the classes are known; large buckets are cut into pairs of blocks.

Words are as in ``simhash``: split at blanks, lower-cased in A-Z only.

Defined cases: a null or empty text has an empty set, alike to another empty one only; a text
with fewer words than a shingle is one shingle; rows equal in id and text are one row; an empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.components import components
from veilframe.llm.shared import partitions, row_key, stored
from veilframe.llm.spotsigs import likeness

#: Words of a shingle, and the coefficient from which on two sets are alike.
SHINGLE, ALIKE = 5, 0.8
BANDS, ROWS = 24, 4
#: Shingles hashed at a time.
CHUNK = 1 << 10
#: Nodes of a block; a larger bucket is cut into pairs of blocks.
BLOCK = 512
_random = np.random.default_rng(42)
FLIP, TIMES = _random.integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64)
TIMES |= np.uint64(1)
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count, h = max(1, len(words) - SHINGLE + 1), np.zeros(1, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        h = h * STEP + ids[k : k + count]
    return np.unique(_mixed(h))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A hash for each band of a set that isn't empty."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        least = np.minimum(least, ((hashes[start : start + CHUNK] ^ FLIP) * TIMES).min(axis=1))
    out = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        out = _mixed(out * STEP + row)
    return out


def _node(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes())


def _printed(texts: pd.Series) -> pd.DataFrame:
    sets = [shingles(t) for t in texts]
    nodes = np.array([_node(s) for s in sets], np.uint64).view(np.int64)
    return pd.DataFrame({"node": nodes, "bands": [bands(s).view(np.int64) if len(s) else [] for s in sets]})


def _shingled(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(t).view(np.int64) for t in texts])


def _joined(sets: list[np.ndarray], classes: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that join the classes of a bucket as far as their alike sets do; places in ``sets``."""
    sizes = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts, mine = np.r_[0, np.cumsum(sizes)[:-1]], np.zeros(len(values), bool)
    left, a, b = np.ones(len(sets), bool), [], []
    while left.any():
        queue = list(np.flatnonzero(left & (classes == classes[np.argmax(left)])))
        left[queue] = False
        while queue and left.any():
            one = queue.pop()
            own = flat[starts[one] : starts[one] + sizes[one]]
            near = np.flatnonzero(left & (np.minimum(sizes, sizes[one]) >= ALIKE * np.maximum(sizes, sizes[one])))
            if not len(near):
                continue
            mine[own] = True
            at = np.repeat(starts[near] - np.r_[0, np.cumsum(sizes[near])[:-1]], sizes[near]) + np.arange(sizes[near].sum())
            both = np.add.reduceat(mine[flat[at]].astype(np.int64), np.r_[0, np.cumsum(sizes[near])[:-1]])
            mine[own] = False
            found = near[both / (sizes[near] + sizes[one] - both) >= ALIKE]
            a += [one] * len(found)
            b += list(found)
            more = np.flatnonzero(left & np.isin(classes, classes[found]))
            left[more] = False
            queue += list(more)
    return a, b


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    group, held = ["band", "value", "x", "y"], None

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = _joined(list(rows["s"]), rows["class"].to_numpy())
        nodes = rows["node"].to_numpy()
        return pd.DataFrame({"a": nodes[a], "b": nodes[b]}, dtype=np.int64)

    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(held):
            continue
        columns = [held[c].to_numpy() for c in group]
        edges = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
        for start, end in zip(edges, edges[1:], strict=False):
            yield linked(held.iloc[start:end])
        held = held.iloc[edges[-1] :]  # may go on in the next batch; at most two blocks
    if held is not None and len(held):
        yield linked(held)


def links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links whose components are those of all alike pairs that share a bucket.

    ``members``: band, value, node, anchor (smallest node of the bucket), n (its nodes); ``sets``: node, s.
    """
    left, right = (sets.toDF(*names) for names in (("l", "u"), ("r", "w")))
    pairs = members.where("node <> anchor").select(F.col("node").alias("a"), F.col("anchor").alias("b")).distinct()
    pairs = pairs.join(left, F.col("a") == F.col("l")).join(right, F.col("b") == F.col("r"))
    found = stored(pairs.where(likeness(F.col("u"), F.col("w")) >= ALIKE).select("a", "b"), "links")

    classes = components(found).select(F.col("node").alias("c"), "component")
    named = members.where("n > 2").join(classes, F.col("node") == F.col("c"), "left")
    named = stored(named.select("band", "value", "node", "n", F.coalesce("component", "node").alias("class")), "buckets")
    mixed = named.groupBy(F.col("band").alias("i"), F.col("value").alias("v")).agg(F.min("class").alias("p"), F.max("class").alias("q"))
    several = named.join(mixed.where("p <> q"), (F.col("band") == F.col("i")) & (F.col("value") == F.col("v")))
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("node"), blocks)
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    dealt = several.select("band", "value", F.explode(tiles).alias("tile"), "node", "class").select("band", "value", "tile.*", "node", "class")
    dealt = dealt.join(left, F.col("node") == F.col("l")).drop("l").withColumnRenamed("u", "s")
    group = ["band", "value", "x", "y"]
    dealt = dealt.repartition(partitions(members.sparkSession), *group).sortWithinPartitions(*group)
    return found.union(dealt.mapInPandas(_compare, "a long, b long").distinct())


def firsts(docs: DataFrame) -> DataFrame:
    """key_id, key_hash of the first row by id of each class of ``docs`` (doc_id, text)."""
    rows = docs.select(*row_key(F.col("doc_id"), F.col("text")), "text")
    printed, shingled = F.pandas_udf(_printed, "node long, bands array<long>"), F.pandas_udf(_shingled, "array<long>")
    prints = rows.select("key_id", "key_hash", printed("text").alias("print")).select("key_id", "key_hash", "print.*")
    nodes = prints.groupBy("node").agg(F.min(F.struct("key_id", "key_hash")).alias("first"), F.first("bands").alias("bands"))
    nodes = stored(nodes, "nodes")

    keys = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    buckets = keys.groupBy(F.col("band").alias("i"), F.col("value").alias("v")).agg(F.min("node").alias("anchor"), F.count("*").alias("n")).where("n > 1")
    members = keys.join(buckets, (F.col("band") == F.col("i")) & (F.col("value") == F.col("v"))).select("band", "value", "node", "anchor", "n")
    members = stored(members, "members")
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", F.col("first.key_id").alias("j"), F.col("first.key_hash").alias("k"))
    texts = rows.join(wanted, (F.col("key_id") == F.col("j")) & (F.col("key_hash") == F.col("k"))).dropDuplicates(["node"])
    sets = stored(texts.select("node", shingled("text").alias("s")), "shingles")

    classes = components(links(members, sets)).select(F.col("node").alias("c"), "component")
    named = nodes.join(classes, F.col("node") == F.col("c"), "left").select("first", F.coalesce("component", "node").alias("class"))
    return named.groupBy("class").agg(F.min("first").alias("first")).select("first.*")

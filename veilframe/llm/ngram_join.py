"""Texts joined on the Jaccard coefficient of their sets of word n-grams, by rare-first prefix filtering.

All n-grams stand in one order: rare ones first, by how often their hash bucket (one of
``BUCKETS``) occurs in all documents, then by hash.  Sets that reach the coefficient share an
n-gram within their first ``n - ceil(share * n) + 1``, their prefixes.  Prefix n-grams are the
keys of the join.  A pair that meets under a key must pass

* the length filter (the smaller set holds enough n-grams at all),
* the positional filter (the n-grams after the two places still suffice for the overlap), and
* the suffix filter (how many n-grams after the two places fall in each of ``RANGES`` ranges of
  hashes: the differences, and what stands before the places, bound the symmetric difference),

and is then compared once, by both whole sets.

What joins is a set, not a document: equal sets are one node, so copies are never paired.  A
key's nodes are first compared with one of them only, in ``ROUNDS`` rounds with another one
each time and only where the key still holds nodes of several classes.  That one has then met
all others under the key and leaves it; a key of two nodes is done after one round.  What is of
one class needs no further comparison; all other pairs under a key are compared in tiles of
``BLOCK`` rows by ``BLOCK`` rows, so that no task sees a whole hot key.  A pair's bound holds at
the first n-gram both share, and every key is visited until all its pairs have met, so no pair is
lost.

N-grams and sets are 64-bit and 128-bit hashes; counts go into the join exactly.

Defined cases: words are split at blanks and line ends and lower-cased in A-Z only; a text with
fewer words than an n-gram is one n-gram; a null text or one without words has an empty set and
is linked with nothing; rows equal in id and text are one node like all equal sets; a null id is
passed on, and ignored for the smallest id unless a class has no other; an empty table gives no
row; columns of ``docs`` beyond doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.components import components
from veilframe.llm.shared import batches_of, pack, partitions, replaced, row_key, stored, unpack

#: Words of an n-gram, and the coefficient from which on two sets are linked, in percent.
SHINGLE, SHARE = 3, 90
#: Hash buckets in which n-grams are counted; the table that tasks get holds a byte for each.  Parts in which counts are sent.
BUCKETS, PARTS = 1 << 22, 1 << 7
#: Ranges of the suffix filter, and the highest count it is told; lower differences let more pairs through, never fewer.
RANGES, HIGHEST = 32, (1 << 15) - 1
#: Bits of the filters for keys and rows; their size doesn't depend on the data.
BITS = 1 << 26
#: Rounds in which a key's nodes are compared with one of them.
ROUNDS = 2
#: Rows of a tile's side, and texts that a task holds at a time.
BLOCK, TEXTS = 512, 500
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def ngrams(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct n-grams' hashes, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count, h = max(1, len(words) - size + 1), np.zeros(1, np.uint64)
    for k in range(min(size, len(words))):
        h = h * STEP + ids[k : k + count]
    h = (h ^ (h >> np.uint64(29))) * MIX
    return np.unique(h ^ (h >> np.uint64(32)))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def prefix_length(n: int, share: int) -> int:
    return n - -(-share * n // 100) + 1


def bucket_levels(docs: DataFrame, size: int) -> np.ndarray:
    """For each hash bucket a byte that grows with the logarithm of its n-grams' occurrences in all texts.

    Tasks send their counts in ``PARTS`` parts, which Spark gathers and adds up; a byte for each bucket comes to the driver.
    """

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, _bucket(ngrams(text, size)), 1)
        parts = total.reshape(PARTS, -1)
        some = np.flatnonzero(parts.any(axis=1))
        yield pd.DataFrame({"part": some.astype(np.int32), "counts": [pack(parts[k]) for k in some]})

    def level(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(map(unpack, part["counts"]))
        levels = np.floor(np.log2(np.maximum(total, 1)) * 4).astype(np.uint8)
        return pd.DataFrame({"part": part["part"][:1], "levels": [levels.tobytes()]})

    sent = docs.select("text").mapInPandas(counts, "part int, counts binary")
    levels = np.zeros((PARTS, BUCKETS // PARTS), np.uint8)
    for r in sent.groupBy("part").applyInPandas(level, "part int, levels binary").collect():
        levels[r["part"]] = np.frombuffer(r["levels"], np.uint8)
    return levels.ravel()


def ordered(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The n-grams with rare ones first."""
    return hashes[np.lexsort((hashes, levels[_bucket(hashes)]))]


def histogram(hashes: np.ndarray) -> np.ndarray:
    """How many n-grams fall in each range."""
    return np.bincount(_range(hashes), minlength=RANGES)


def sketches(docs: DataFrame, levels: Broadcast, size: int, share: int) -> DataFrame:
    """doc_id, key_id, key_hash, and of each set: node (null if empty), n, prefix, histogram."""

    @F.pandas_udf("node binary, n long, prefix array<long>, histogram array<int>")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            h = ngrams(text, size)
            first = ordered(h, levels.value)[: prefix_length(len(h), share)].view(np.int64).copy() if len(h) else []  # a copy lets go of the rest
            rows.append((xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None, len(h), first, histogram(h)))
        return pd.DataFrame(rows, columns=["node", "n", "prefix", "histogram"])

    rows = docs.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), of("text").alias("sketch"))
    return rows.select("doc_id", "key_id", "key_hash", "sketch.*")


def bit_filter(keys: DataFrame, key: str) -> np.ndarray:
    """``BITS`` bits; those of the long column ``key`` are set.  Built in Spark; only the bits come to the driver."""
    place = F.pmod(F.col(key), F.lit(BITS)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in parts.collect():  # one for each 32,768 bits
        start = (r["part"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys % np.int64(BITS)
    return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1


def entries(nodes: DataFrame) -> DataFrame:
    """key, id, n, pos, rest: the prefix n-grams that stand in two prefixes or more, and few others.

    ``rest`` counts the n-grams after the place by range, which is what the suffix filter needs to know of a set.
    """
    spark = nodes.sparkSession
    counted = nodes.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("nodes"))
    bits = spark.sparkContext.broadcast(bit_filter(counted.where("nodes > 1"), "key"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            prefixes, whole = batch.column("prefix"), batch.column("histogram").flatten().to_numpy().reshape(-1, RANGES)
            keys, lengths = prefixes.flatten().to_numpy(), prefixes.value_lengths().to_numpy()
            starts = np.cumsum(lengths) - lengths
            owner = np.repeat(np.arange(len(lengths)), lengths)
            at = np.flatnonzero(in_filter(bits.value, keys))
            rest = np.minimum(suffixes(keys, starts, owner, whole)[at], HIGHEST).astype(np.int16)
            owner = owner[at]
            columns = {
                "key": pa.array(keys[at]),
                "id": batch.column("id").take(pa.array(owner)),
                "n": batch.column("n").take(pa.array(owner)),
                "pos": pa.array((at - starts[owner]).astype(np.int32)),
                "rest": pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * RANGES, rest.ravel()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    with batches_of(spark, TEXTS):
        return stored(nodes.select("id", "n", "prefix", "histogram").mapInArrow(placed, "key long, id long, n long, pos int, rest array<short>"), "entries")


def passes(share: int, m: Column, i: Column, a: Column, n: Column, j: Column, b: Column) -> Column:
    """Length, positional and suffix filter for sets of m and n n-grams that share those at places i and j, with counts a and b after them."""
    long_enough = 100 * F.least(m, n) >= share * F.greatest(m, n)
    enough_left = F.least(m - i, n - j) * (100 + share) >= share * (m + n)
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda total, x: total + x)
    most = m + n - 2 * F.ceil(share * (m + n) / F.lit(100 + share)).cast("long")
    return long_enough & enough_left & (i + j + apart <= most)


def _range(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)


def suffixes(keys: np.ndarray, starts: np.ndarray, owner: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """For each place of prefixes that stand one after the other: how many n-grams of its set come after it, by range."""
    until = np.zeros((len(keys) + 1, RANGES), np.int32)
    until[np.arange(1, len(keys) + 1), _range(keys.view(np.uint64))] = 1
    np.cumsum(until, axis=0, out=until)
    return whole[owner] - (until[1:] - until[starts[owner]])


def _suffix(prefix: np.ndarray, counts: np.ndarray, at: int) -> np.ndarray:
    return counts - histogram(np.asarray(prefix[: at + 1], np.int64).view(np.uint64)).astype(np.int32)


def linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """a, b, m, n, same of the distinct ``pairs`` (a, b): sizes of the two sets and of what they share."""
    spark = nodes.sparkSession
    close = stored(pairs.distinct(), "candidates")
    ids = close.select(F.col("a").alias("id")).union(close.select("b")).distinct()
    wanted = stored(ids.join(nodes.select("id", "first"), "id").select("id", "first.*"), "wanted")
    bits = spark.sparkContext.broadcast(bit_filter(wanted, "key_hash"))

    @F.pandas_udf("array<long>")
    def whole(keys: pd.Series, texts: pd.Series) -> pd.Series:
        marked = in_filter(bits.value, keys.to_numpy()) if len(keys) else []
        return pd.Series([ngrams(t, size).view(np.int64) if f else None for f, t in zip(marked, texts, strict=True)])

    rows = docs.select(*row_key(F.col("doc_id"), F.col("text")), "text").select("key_id", "key_hash", whole("key_hash", "text").alias("grams"))
    sets = rows.where("grams IS NOT NULL").join(wanted, ["key_id", "key_hash"]).dropDuplicates(["key_id", "key_hash"]).select("id", "grams")
    with batches_of(spark, TEXTS):
        sets = stored(sets, "sets")
    u, w = sets.toDF("a", "u"), sets.toDF("b", "w")
    return close.join(u, "a").join(w, "b").select("a", "b", F.size("u").alias("m"), F.size("w").alias("n"), F.size(F.array_intersect("u", "w")).alias("same"))


def _with_classes(rows: DataFrame, links: DataFrame) -> DataFrame:
    classes = components(links).select(F.col("node").alias("x"), "component")
    return rows.drop("class").join(classes, F.col("id") == F.col("x"), "left").withColumn("class", F.coalesce("component", "id")).drop("x", "component")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows under keys that hold several classes; ``nodes`` says how many rows a key has."""
    found = rows.groupBy(F.col("key").alias("k")).agg(F.min("class").alias("p"), F.max("class").alias("q"), F.count("*").alias("nodes")).where("p <> q")
    return rows.join(found.select("k", "nodes"), F.col("key") == F.col("k")).drop("k")


def _met(rows: DataFrame, seed: int, share: int) -> DataFrame:
    """Each row beside one node of its key, another one for each seed: ``one`` its id, ``near`` whether both are to be compared.

    ``others`` counts what the key holds besides that node.  Hashes of ids with one seed are never equal.
    """
    held = ["key", "id", "n", "pos", "rest", "class"]
    one = F.min_by(F.struct("id", "n", "pos", "rest", "class"), F.xxhash64(F.lit(seed), "id")).alias("one")
    anchors = rows.groupBy(F.col("key").alias("k")).agg(one, (F.count("*") - 1).alias("others")).where("others > 0")
    near = passes(share, F.col("n"), F.col("pos"), F.col("rest"), F.col("one.n"), F.col("one.pos"), F.col("one.rest"))
    met = rows.join(anchors, F.col("key") == F.col("k")).where(F.col("id") != F.col("one.id"))
    return met.select(*held, "others", F.col("one.id").alias("one"), (near & (F.col("class") != F.col("one.class"))).alias("near"))


def _tile_pairs(rows: DataFrame, share: int) -> DataFrame:
    """All pairs of nodes of a key that are of different classes and pass the filters; no task sees more than two blocks of a key."""
    blocks = F.ceil(F.col("nodes") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("id"), blocks)
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    group = ["key", "x", "y"]
    held = ["id", "n", "pos", "class", "rest"]
    dealt = rows.select("key", F.explode(tiles).alias("tile"), *held).select("key", "tile.*", *held)
    dealt = dealt.repartition(partitions(rows.sparkSession), *group).sortWithinPartitions(*group)

    def inside(rows: pd.DataFrame, groups: np.ndarray) -> pd.DataFrame:
        """The pairs of rows of one group, each with those after it, a distance at a time."""
        ids, n, pos, classes = (rows[c].to_numpy() for c in ("id", "n", "pos", "class"))
        rest = np.array([np.asarray(r, np.int32) for r in rows["rest"]], np.int32).reshape(len(rows), RANGES)
        met, at, d = [], np.arange(len(rows)), 1
        while len(at):
            at = at[at + d < len(rows)]
            at = at[groups[at] == groups[at + d]]
            m, i, n2, j = n[at], pos[at], n[at + d], pos[at + d]
            fits = (100 * np.minimum(m, n2) >= share * np.maximum(m, n2)) & (np.minimum(m - i, n2 - j) * (100 + share) >= share * (m + n2))
            found = at[fits & (classes[at] != classes[at + d])]
            total = n[found] + n[found + d]
            apart = pos[found] + pos[found + d] + np.abs(rest[found] - rest[found + d]).sum(axis=1)
            found = found[apart <= total - 2 * -(-share * total // (100 + share))]
            met.append(np.c_[found, found + d])
            d += 1
        pairs = np.sort(ids[np.concatenate(met or [np.empty((0, 2), np.int64)])], axis=1)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(held):
                continue
            columns = [held[c].to_numpy() for c in group]
            groups = np.cumsum(np.r_[False, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
            done = groups < groups[-1]
            yield inside(held[done], groups[done])
            held = held[~done]  # may go on in the next batch
        if held is not None and len(held):
            yield inside(held, np.zeros(len(held), np.int64))

    return dealt.mapInPandas(compare, "a long, b long")


def join_classes(docs: DataFrame, size: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for each row of ``docs`` (doc_id, text)."""
    with batches_of(docs.sparkSession, TEXTS):
        levels = docs.sparkSession.sparkContext.broadcast(bucket_levels(docs, size))
        rows = stored(sketches(docs, levels, size, share), "sketches")
    firsts = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("key_id", "key_hash")).alias("first"),
        F.min("doc_id").alias("least"),
        *[F.first(c).alias(c) for c in ("n", "prefix", "histogram")],
    )
    nodes = stored(firsts.withColumn("id", F.monotonically_increasing_id()), "nodes")  # written, so that the numbers stay
    rows = replaced(rows, rows.select("doc_id", "node", "n"), "rows")

    under = entries(nodes).withColumn("class", F.col("id"))
    links = None
    for seed in range(ROUNDS + 1):
        if seed < ROUNDS:
            met = stored(_met(under, seed, share), "met")
            pairs = met.where("near").select(F.least("id", "one").alias("a"), F.greatest("id", "one").alias("b"))
        else:
            pairs = _tile_pairs(under, share)
        compared = linked(pairs, nodes, docs, size)
        found = stored(compared.where(100 * F.col("same") >= share * (F.col("m") + F.col("n") - F.col("same"))).select("a", "b"), "found")
        links = found if links is None else links.union(found)
        if seed < ROUNDS:
            under = replaced(met, _mixed(_with_classes(met.where("others > 1").drop("others", "one", "near"), links)), "mixed")

    named = stored(_with_classes(nodes.select("node", "id", "least"), links), "classes")
    least = named.groupBy(F.col("class").alias("c")).agg(F.min("least").alias("component_id"))
    by_node = named.join(least, F.col("class") == F.col("c")).select(F.col("node").alias("x"), "component_id")
    joined = rows.select("doc_id", "node", "n").join(by_node, F.col("node") == F.col("x"), "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))

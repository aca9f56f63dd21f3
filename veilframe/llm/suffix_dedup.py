"""Remove repeated byte strings with an externally sorted, induced suffix array.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else too.  Such a
string is the prefix of two suffixes whose common prefix is that long, so they are neighbours
in a suffix array of the corpus.  Only the part of the array that can hold repeats is built:

* Sampled suffixes.  Every string of ``LENGTH`` bytes has an anchor, the run of ``GRAM`` bytes in it
  with the least hash (the last of equals).  Equal strings have equal anchors at the same place,
  so each start belongs to one anchor, and starts whose anchor hash stands once in the corpus
  are done.
* Sorting.  The suffixes at the anchors are dealt by anchor hash and sorted within each shard by
  Spark's external sort, which spills runs to disk and merges them through a priority queue.
  A task reads its shard as a stream and holds a few thousand suffixes, however large the shard.
* Induction.  The suffix one byte before has the order of the suffix after it, split by the byte
  in front; the common prefix of two new neighbours is the least of those between them.  So order
  and common-prefix values are carried to the left from the anchors, byte by byte, as long as
  a repeat is possible; no bytes are compared again.

Contexts (an anchor with all strings that belong to it) that are equal are one class and count once in the
sorting.  An anchor with more than ``HOT`` different contexts isn't sorted in one task: its strings
are counted one by one with partial sums, which gives the same result.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` lose nothing; strings don't cross
texts; rows that repeat are copies of each other; cuts go by bytes, also inside a character;
an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import partitions, row_key, stored

LENGTH, GRAM = 200, 32
#: Different contexts of an anchor that one task sorts, and contexts that a task works on at a time.
HOT, AT_ONCE = 50_000, 20_000
#: Bytes that a task samples at a time; a longer text is cut, its strings aren't.
PIECE = 1 << 21
KEY = ["key_id", "key_hash"]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on, by doubling."""
    h, width = data.astype(np.uint64) + np.uint64(1), 1
    while width < GRAM:
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


def _anchors(hashes: np.ndarray, length: int) -> np.ndarray:
    """For each start of a string, the place of the least hash in it, the last of equals."""
    wide = length - GRAM + 1
    low = np.uint64(0xFFFFFFFF)
    least, width = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64)), 1
    while 2 * width <= wide:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wide:
        least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])
    return (low - (least & low)).astype(np.int64)


def blocks_of(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, cut into pieces of ``PIECE`` string starts, in blocks of about ``PIECE`` bytes: text, offset and bytes of each piece."""
    which, offsets, pieces, size = [], [], [], 0
    for k, text in enumerate(texts):
        for a in range(0, len(text) - length + 1, PIECE):
            which.append(k)
            offsets.append(a)
            pieces.append(text[a : a + PIECE + length - 1])
            size += len(pieces[-1])
            if size >= PIECE:
                yield which, offsets, pieces
                which, offsets, pieces, size = [], [], [], 0
    if pieces:
        yield which, offsets, pieces


def contexts_of(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Number of the text, anchor hash, context hash and packed place (start, anchor, strings) of every anchor."""
    joined = b"".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    if len(joined) < length:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    hashes = _gram_hashes(np.frombuffer(joined, np.uint8))
    anchor = _anchors(hashes, length)
    text = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= ends[text]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(whole & (new | np.r_[True, ~whole[:-1]]))
    last = np.flatnonzero(whole & np.r_[new[1:] | ~whole[1:], True])
    view = memoryview(joined)
    digest = xxhash.xxh3_64_intdigest
    context = np.fromiter((digest(view[a : b + length], s) for a, b, s in zip(first.tolist(), last.tolist(), (anchor[first] - first).tolist(), strict=True)), np.uint64, len(first))
    start = first - (ends - sizes)[text[first]]
    place = (start << 16) | ((anchor[first] - first) << 8) | (last - first)
    return text[first], hashes[anchor[first]].view(np.int64), context.view(np.int64), place


# a packed place: start in the text, bytes from there to the anchor, strings less one
START, AHEAD, MORE = "(place >> 16)", "((place >> 8) & 255)", "(place & 255)"


def _prefixes(rows: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before in its group, -1 for the first."""
    out = np.full(len(rows), -1, np.int64)
    differ = rows[1:] != rows[:-1]
    at = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    same = groups[1:] == groups[:-1]
    out[1:][same] = np.minimum(at, np.minimum(sizes[1:], sizes[:-1]))[same]
    return out


def induce(groups: np.ndarray, right: list[bytes], left: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Which strings of each context repeat: row = context, column = bytes that the string starts before the anchor.

    Contexts come by group, sorted by ``right`` (the bytes from the anchor on); ``left`` has
    the bytes in front, nearest first.
    """
    n = len(groups)
    wide = max(map(len, left), default=0)
    behind = np.array([len(x) for x in right])
    rows = np.frombuffer(b"".join(x.ljust(length, b"\0") for x in right), np.uint8).reshape(n, length)
    front = np.frombuffer(b"".join(x.ljust(wide + 1, b"\0") for x in left), np.uint8).reshape(n, wide + 1)
    most = np.array([len(x) for x in left])
    repeats = np.zeros((n, wide + 1), bool)
    who, node, common = np.arange(n), np.unique(groups, return_inverse=True)[1].astype(np.int64), _prefixes(rows, behind, groups)
    for t in range(wide + 1):
        best = np.maximum(common, np.r_[common[1:], -1])
        repeats[who[best >= length - t], t] = True
        kept = np.flatnonzero((best >= length - most[who]) & (most[who] > t))
        if not len(kept):
            break
        byte = front[who[kept], t].astype(np.int64)
        order = np.argsort(node[kept] * 256 + byte, kind="stable")
        at, key = kept[order], (node[kept] * 256 + byte)[order]
        new = np.r_[True, key[1:] != key[:-1]]
        pairs = np.flatnonzero(~new)
        carried = np.full(len(at), -1, np.int64)
        if len(pairs):
            bounds = np.stack([at[pairs - 1] + 1, at[pairs] + 1], axis=1).ravel()
            carried[pairs] = np.minimum.reduceat(np.r_[common, -1], bounds)[::2]
        who, node, common = who[at], np.cumsum(new) - 1, carried
    return repeats


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of true values."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _packed(docs: DataFrame) -> DataFrame:
    """Key and compressed text, so that a shuffle moves a third of the bytes."""

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=3)
        return texts.map(lambda t: press.compress(t.encode()))

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), pack(text).alias("packed"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """key_id, key_hash, start, end: bytes of the rows of ``docs`` that repeat; spans may overlap."""

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for which, offsets, pieces in blocks_of([t.encode() for t in batch["text"]], length):
                piece, anchor, context, place = contexts_of(pieces, length)
                keys = batch[KEY].iloc[np.array(which)[piece]]
                yield keys.assign(anchor=anchor, context=context, place=place + (np.array(offsets)[piece] << 16))

    keyed = docs.where(F.octet_length("text") >= length).select(*row_key(F.col("doc_id"), F.col("text")), "text")
    sampled = stored(keyed.mapInPandas(sample, "key_id long, key_hash long, anchor long, context long, place long"), "anchors")
    # written, so that the join deals both sides itself and can split an anchor that stands very often
    often = stored(sampled.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "often")
    repeated = stored(sampled.join(often, "anchor", "left_semi"), "repeated")

    one = F.min(F.struct("key_id", "key_hash", "place")).alias("one")
    classes = stored(repeated.groupBy("anchor", "context").agg(F.count("*").alias("n"), one), "classes")
    several = classes.groupBy(F.col("anchor").alias("x")).agg(F.count("*").alias("contexts")).where("contexts > 1")
    open_ = classes.join(several, F.col("anchor") == F.col("x")).select("anchor", "context", "n", "one.*", (F.col("contexts") > HOT).alias("hot"))
    bytes_of = stored(_cut(docs, open_, length), "contexts")
    runs = _sorted_runs(bytes_of.where("NOT hot"), length).unionByName(_counted_runs(bytes_of.where("hot"), length))

    by_class = repeated.join(classes.select(F.col("anchor").alias("x"), F.col("context").alias("y"), "n"), (F.col("anchor") == F.col("x")) & (F.col("context") == F.col("y")))
    copies = by_class.where("n > 1").selectExpr(*KEY, f"{START} AS start", f"{START} + {MORE} + {length} AS end")
    alone = by_class.where("n = 1").selectExpr(*KEY, "anchor", "context", f"{START} + {AHEAD} AS at")
    found = alone.join(runs, ["anchor", "context"]).select(*KEY, (F.col("at") - F.col("last")).alias("start"), (F.col("at") - F.col("first") + length).alias("end"))
    return copies.unionByName(found)


def _cut(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """The bytes of one context of each class: anchor, context, n, hot, left (nearest first), right, nearest."""
    wanted = classes.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "context", "n", "hot", "place")).alias("wanted"))  # of one text
    texts = _packed(docs).drop("doc_id").join(wanted.toDF("i", "h", "wanted"), (F.col("key_id") == F.col("i")) & (F.col("key_hash") == F.col("h")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for packed, wanted in zip(batch["packed"], batch["wanted"], strict=True):
                text = unpack.decompress(packed)
                for w in wanted:
                    start, ahead, more = w["place"] >> 16, w["place"] >> 8 & 255, w["place"] & 255
                    at = start + ahead
                    out.append((w["anchor"], w["context"], w["n"], w["hot"], text[start:at][::-1], text[at : start + more + length]))
            yield pd.DataFrame(out, columns=["anchor", "context", "n", "hot", "left", "right"])

    cuts = texts.select("packed", "wanted").mapInPandas(cut, "anchor long, context long, n long, hot boolean, left binary, right binary")
    return cuts.dropDuplicates(["anchor", "context"])  # rows that repeat cut the same


def _sorted_runs(contexts: DataFrame, length: int) -> DataFrame:
    """anchor, context, first, last: runs of repeated strings, as bytes before the anchor; of classes with one member."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= AT_ONCE:
                rows = pd.concat(held, ignore_index=True)
                last = rows["anchor"].to_numpy() == rows["anchor"].iloc[-1]  # this group may go on
                held = [rows[last]]
                yield found(rows[~last])
        yield found(pd.concat(held, ignore_index=True) if held else None)

    def found(rows: pd.DataFrame | None) -> pd.DataFrame:
        if rows is None or not len(rows):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("anchor", "context", "first", "last")})
        repeats = induce(rows["anchor"].to_numpy(), rows["right"].tolist(), rows["left"].tolist(), length)
        repeats[rows["n"].to_numpy() > 1] = False  # their strings all repeat, which is known
        row, first, last = _runs(repeats)
        return rows[["anchor", "context"]].iloc[row].assign(first=first, last=last)

    dealt = contexts.select("anchor", "context", "n", "left", "right").repartition(partitions(contexts.sparkSession), "anchor")
    return dealt.sortWithinPartitions("anchor", "right").mapInPandas(merge, "anchor long, context long, first long, last long")


def _counted_runs(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: each string is counted by its hash."""
    nearest, farthest = F.lit(length) - F.octet_length("right"), F.octet_length("left")
    t = F.explode(F.sequence(nearest, farthest)).alias("t")
    string = F.concat(F.substring("left", F.lit(1), F.col("t")), F.substring("right", F.lit(1), F.lit(length) - F.col("t")))
    strings = contexts.select("anchor", "context", "n", t, "left", "right").select("anchor", "context", "n", "t", F.sha2(string, 256).alias("s"))
    often = strings.groupBy(F.col("anchor").alias("x"), F.col("t").alias("u"), F.col("s").alias("v")).agg(F.count("*").alias("c")).where("c > 1")
    same = (F.col("anchor") == F.col("x")) & (F.col("t") == F.col("u")) & (F.col("s") == F.col("v"))
    found = strings.where("n = 1").join(often, same, "left_semi")
    return found.select("anchor", "context", F.col("t").cast("long").alias("first"), F.col("t").cast("long").alias("last"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay), one row for each of ``docs``."""
    spans = repeated_spans(docs, length).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # of one text
    texts = _packed(docs).join(spans.toDF("i", "h", "spans"), (F.col("key_id") == F.col("i")) & (F.col("key_hash") == F.col("h")), "left")

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    def remove(packed: pd.Series, spans: pd.Series) -> pd.DataFrame:
        unpack, out = zstandard.ZstdDecompressor(), []
        for data, found in zip(packed, spans, strict=True):
            text, kept, end, runs = unpack.decompress(data), [], 0, 0
            for a, b in sorted((s["start"], s["end"]) for s in found) if found is not None else ():
                if a > end or not runs:
                    kept.append(text[end:a])
                    runs += 1
                end = max(end, b)
            rest = b"".join([*kept, text[end:]])
            out.append((len(text), len(text) - len(rest), runs, hashlib.sha256(rest).hexdigest(), rest))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.select("doc_id", remove("packed", "spans").alias("r")).select("doc_id", "r.*")

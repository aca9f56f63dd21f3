"""Phrases of two to five words that stand together more often than their parts would, per language.

Frequencies are counted by direct addressing.  Frequent words are numbered by rank, frequent
ones first; a pair of numbers (left, right) is a cell of a matrix that is cut into tiles of
``SIDE`` by ``SIDE`` cells.  Where a task has many pairs in a tile, it counts them into a dense
array; pairs of all other tiles are sorted and counted as coordinates.  Spark adds up the cells
of all tasks.  Frequent pairs are then ranked and numbered like words, and (pair, word) makes the
next matrix, and so on up to five words: a phrase can be frequent only if the phrases without its
last and without its first word are.

Texts are dictionary-encoded once, in chunks of one language of about ``CHUNK`` words.  For each length the
chunks ask for the numbers of what stands in them (a join over distinct pairs of chunk and pair,
thinned out by a bit filter of fixed size over the frequent pairs), so no task needs a whole
dictionary, whatever its size.  They ask and keep only what can still be part of a longer phrase.

Defined cases: pieces end at ``[.,;:!?]`` and at line ends, words at blanks and tabs; words are
lower-cased in A-Z only; a null text is empty, a null language is ``und``; repeated rows count as
often as they stand; an empty table gives no row; columns beyond lang and text don't matter.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.ngram_join import BITS, bit_filter, in_filter
from veilframe.llm.shared import batches_of, pack, replaced, running_total, stored, unpack

#: Words of a phrase at most, and occurrences at least.
WIDEST, LEAST = 5, 100
#: A phrase goes if a longer one around it has this share of its occurrences, in percent.
SUBSUMED = 100
#: Phrases for each language.
TOP = 2000
#: Words of a chunk; a longer text is a chunk of its own.
CHUNK = 1 << 19
#: Texts, and chunks, that a task holds at a time.
TEXTS, CHUNKS = 500, 4
#: Binary digits of a tile's side; tiles of one dense region are told apart by number.
SIDE, TILES = 10, 64
#: Pairs of a tile from which on it is counted densely, and pairs that are counted at a time.
DENSE, FLUSH = 1 << 15, 1 << 21
#: The lower half of a pair's code.
HALF = 0xFFFFFFFF
#: For the bit filter: a prime below its size, and two factors.
PRIME, LEFT, RIGHT = BITS - 5, 2654435761, 1000003
SEPARATORS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


def squeeze(numbers: np.ndarray) -> bytes:
    """Packed, and compressed by how often each byte occurs, which a shuffle's own compression doesn't do."""
    return zlib.compress(pack(numbers), 1)


def spread_out(packed: bytes) -> np.ndarray:
    return unpack(zlib.decompress(packed))


def tokens(text: str | None) -> list[bytes]:
    """Words, with a line end wherever a piece ends."""
    data = (text or "").encode().lower().translate(SEPARATORS).replace(b"\n", b" \n ")
    return [w for w in data.split(b" ") if w]


class _Chunk:
    def __init__(self) -> None:
        self.numbers = defaultdict(count().__next__)
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, chunk: int, lang: str) -> dict:
        codes, words = np.concatenate(self.codes), list(self.numbers)
        counts = np.bincount(codes, minlength=len(words))
        end = self.numbers.get(b"\n", -1)
        codes[codes == end] = -1  # the number of the piece end stays unused
        if end >= 0:
            counts[end] = 0
        return {"chunk": chunk, "lang": lang, "words": [w.decode("utf-8", "replace") for w in words], "counts": counts, "codes": squeeze(codes)}


def chunks(docs: DataFrame) -> DataFrame:
    """chunk, lang, words (distinct), counts, codes (places in words; -1 ends a piece)."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_chunks: dict[str, _Chunk] = {}
        numbers = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if words := tokens(text):
                    chunk = open_chunks.setdefault(lang, _Chunk())
                    chunk.add([*words, b"\n"])
                    full = [lang] if chunk.size >= CHUNK else list(open_chunks) if sum(c.size for c in open_chunks.values()) >= 4 * CHUNK else []
                    for k in full:
                        yield pd.DataFrame([open_chunks.pop(k).row(next(numbers), k)])
        for k, chunk in open_chunks.items():
            yield pd.DataFrame([chunk.row(next(numbers), k)])

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return rows.mapInPandas(encode, "chunk long, lang string, words array<string>, counts array<long>, codes binary")


def count_cells(codes: np.ndarray) -> pd.DataFrame:
    """code, n: occurrences of each pair of numbers, one in either half of its code."""
    row, column = codes >> 32 + SIDE, (codes & HALF) >> SIDE
    tile = np.where((row < TILES) & (column < TILES), row * TILES + column, TILES * TILES).astype(np.uint16)
    del row, column
    sizes = np.bincount(tile, minlength=TILES * TILES + 1)
    sizes[-1] = 0
    dense = (sizes >= DENSE)[tile]
    found, numbers = np.unique(codes[~dense], return_counts=True)
    parts = [(found, numbers)]
    codes, tile, side = codes[dense], tile[dense], (1 << SIDE) - 1
    inside = ((codes >> 32 & side) << SIDE | codes & side).astype(np.int32)[np.argsort(tile, kind="stable")]
    ends = np.cumsum(sizes[sizes >= DENSE])
    for number, start, end in zip(np.flatnonzero(sizes >= DENSE), np.r_[0, ends], ends, strict=False):
        cells = np.bincount(inside[start:end], minlength=1 << 2 * SIDE)
        found = np.flatnonzero(cells)
        corner = (number // TILES << SIDE) << 32 | (number % TILES << SIDE)
        parts.append((corner + (found >> SIDE << 32) + (found & side), cells[found]))
    codes, n = (np.concatenate(p).astype(np.int64) for p in zip(*parts, strict=True))
    return pd.DataFrame({"code": codes, "n": n})


def pairs_of(units: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places, and numbers in the two halves of a code, of the pairs of a frequent phrase of ``size`` words and the word after it."""
    if len(units) <= size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ahead = words[size:]
    fits = (units[: len(ahead)] >= 0) & (ahead >= 0)
    if size > 1:
        fits &= units[1 : len(ahead) + 1] >= 0  # the phrase without its first word is frequent as well
    at = np.flatnonzero(fits)
    return at, units[at] << 32 | ahead[at]


def extendable(units: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Units of ``size`` words and words without those that no longer phrase can hold: -1 stands for them."""
    at, _ = pairs_of(units, words, size)
    places = np.concatenate([at, at + 1])
    kept, after = np.full(len(units), -1, np.int64), np.full(len(words), -1, np.int64)
    kept[places], after[at + size] = units[places], words[at + size]
    return kept, after


class _Counter:
    """Collects pairs and counts them ``FLUSH`` at a time."""

    def __init__(self) -> None:
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, codes: np.ndarray) -> Iterator[pd.DataFrame]:
        self.held.append(codes)
        self.size += len(codes)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pd.DataFrame]:
        codes, self.held, self.size = self.held, [], 0
        if codes:
            yield count_cells(np.concatenate(codes))


_STATE = "chunk long, words binary, units binary"


def first_state(encoded: DataFrame, numbers: DataFrame) -> DataFrame:
    """chunk, words: the numbers of its words, -1 where none is frequent; units: null, since phrases of one word are the words."""
    name = lambda word: F.xxhash64("lang", word)
    bits = encoded.sparkSession.sparkContext.broadcast(bit_filter(numbers.select(name("phrase").alias("key")), "key"))

    def perhaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lengths = batch.column("keys").flatten().to_numpy(), batch.column("keys").value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(lengths)), lengths)
            some = np.flatnonzero(in_filter(bits.value, keys))
            owner = owner[some]
            columns = {
                "chunk": batch.column("chunk").take(pa.array(owner)),
                "lang": batch.column("lang").take(pa.array(owner)),
                "at": pa.array((some - (np.cumsum(lengths) - lengths)[owner]).astype(np.int32)),
                "word": batch.column("words").flatten().take(pa.array(some)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    asked = encoded.select("chunk", "lang", "words", F.transform("words", name).alias("keys"))
    known = asked.mapInArrow(perhaps, "chunk long, lang string, at int, word string").join(numbers.select("lang", F.col("phrase").alias("word"), "id"), ["lang", "word"])
    maps = known.groupBy("chunk").agg(F.collect_list(F.struct("at", "id")).alias("both")).select("chunk", "both.at", "both.id")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, planes, at, ids in zip(*(batch[c] for c in ("chunk", "codes", "at", "id")), strict=True):
                codes = spread_out(planes)
                table = np.full(max(codes.max(initial=0), at.max(initial=0)) + 2, -1, np.int64)  # the last place is that of -1
                table[at] = ids
                yield pd.DataFrame([{"chunk": chunk, "words": squeeze(table[codes]), "units": None}])

    return encoded.select("chunk", "codes").join(maps, "chunk").mapInPandas(number, _STATE)


def count_pairs(state: DataFrame, size: int) -> DataFrame:
    """code, f: how often each frequent phrase of ``size`` words has a frequent word after it."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _Counter()
        for batch in batches:
            for words, units in zip(batch["words"], batch["units"], strict=True):
                words = spread_out(words)
                yield from counter.add(pairs_of(words if units is None else spread_out(units), words, size)[1])
        yield from counter.flush()

    return state.select("words", "units").mapInPandas(cells, "code long, n long").groupBy("code").agg(F.sum("n").alias("f"))


def next_state(state: DataFrame, frequent: DataFrame, size: int) -> DataFrame:
    """The state for phrases of one word more than ``size``, of which ``frequent`` has code and id."""
    left, right = F.shiftright("code", 32), F.col("code").bitwiseAND(F.lit(HALF))
    bits = state.sparkSession.sparkContext.broadcast(bit_filter(frequent.select(((left * LEFT + right * RIGHT) % PRIME).alias("key")), "key"))

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, words, units in zip(batch["chunk"], batch["words"], batch["units"], strict=True):
                words = spread_out(words)
                at, codes = pairs_of(words if units is None else spread_out(units), words, size)
                some = in_filter(bits.value, ((codes >> 32) * LEFT + (codes & HALF) * RIGHT) % PRIME)
                perhaps = np.full(len(words), -1, np.int64)
                perhaps[at[some]] = codes[some]
                codes = np.unique(extendable(perhaps, words, size + 1)[0])
                yield pd.DataFrame({"chunk": chunk, "code": codes[codes >= 0]})

    known = state.mapInPandas(present, "chunk long, code long").join(frequent.select("code", "id"), "code")
    maps = known.groupBy("chunk").agg(F.collect_list(F.struct("code", "id")).alias("all")).select("chunk", "all.code", "all.id")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, planes, units, keys, ids in zip(*(batch[c] for c in ("chunk", "words", "units", "code", "id")), strict=True):
                words = spread_out(planes)
                at, codes = pairs_of(words if units is None else spread_out(units), words, size)
                order = np.argsort(keys)
                keys = keys[order]
                place = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
                hit = keys[place] == codes
                longer = np.full(len(words), -1, np.int64)
                longer[at[hit]] = ids[order][place[hit]]
                longer, words = extendable(longer, words, size + 1)
                yield pd.DataFrame([{"chunk": chunk, "words": squeeze(words), "units": squeeze(longer)}])

    return state.join(maps, "chunk").mapInPandas(number, _STATE)


def ranked(frequent: DataFrame, *ties: str) -> DataFrame:
    """``frequent`` with ``id``: its rank by frequency."""
    numbered = running_total(frequent.withColumns({"rarity": -F.col("f"), "one": F.lit(1)}), ["rarity", *ties], "one", "id")
    return numbered.drop("rarity", "one")


def frequencies(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, size, f of all phrases of up to ``WIDEST`` words with ``least`` occurrences, and lang, n: all words."""
    with batches_of(docs.sparkSession, TEXTS):
        encoded = stored(chunks(docs), "chunks")
    with batches_of(docs.sparkSession, CHUNKS):
        return _frequencies(encoded, least)


def _frequencies(encoded: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    cells = encoded.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("one")).select("lang", "one.words", "one.counts").where("counts > 0")
    words = stored(cells.groupBy("lang", F.col("words").alias("phrase")).agg(F.sum("counts").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    singles = stored(ranked(words.where(F.col("f") >= least), "lang", "phrase"), "ranked")
    phrases, shorter = [singles.withColumn("size", F.lit(1))], singles
    state = replaced(encoded, first_state(encoded, singles), "state")
    for size in range(1, WIDEST):
        frequent = stored(ranked(count_pairs(state, size).where(F.col("f") >= least), "code"), "ranked")
        left = shorter.select(F.col("id").alias("i"), "lang", F.col("phrase").alias("before"))
        right = singles.select(F.col("id").alias("j"), F.col("phrase").alias("after"))
        halves = frequent.select("f", "id", F.shiftright("code", 32).alias("i"), F.col("code").bitwiseAND(F.lit(HALF)).alias("j"))
        joined = halves.join(left, "i").join(right, "j")
        shorter = stored(joined.select("lang", F.concat_ws(" ", "before", "after").alias("phrase"), "f", "id"), "phrases")
        phrases.append(shorter.withColumn("size", F.lit(size + 1)))
        if size + 1 < WIDEST:
            state = replaced(state, next_state(state, frequent, size), "state")
    out = phrases[0].select("lang", "phrase", "size", "f")
    for one in phrases[1:]:
        out = out.union(one.select("lang", "phrase", "size", "f"))
    return out, totals


def scored(counted: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score at the lowest-scoring cut."""
    whole = counted.where("size > 1")
    parts = F.split("phrase", " ")
    cut = lambda start, length: F.array_join(F.slice(F.col("parts"), start, length), " ")
    cuts = whole.withColumn("parts", parts).select("lang", "phrase", "f", "parts", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "f", "cut", cut(F.lit(1), F.col("cut")).alias("first"), cut(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"))
    left = counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    whole_number = lambda c: F.col(c).cast("decimal(19,0)")
    above = F.lit(1000).cast("decimal(4,0)") * whole_number("f") * whole_number("n")
    all_cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    all_cuts = all_cuts.withColumns({"above": above, "below": whole_number("l") * whole_number("r")}).withColumn("score", F.expr("above div below"))
    lowest = all_cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "f", "n")).alias("one"))
    return lowest.select("lang", "phrase", F.col("one.f").alias("a"), "one.l", "one.r", "one.n", "one.score")


def subsumed(counted: DataFrame) -> DataFrame:
    """lang, phrase, around: for phrases inside longer ones, the highest frequency of those."""
    longer = counted.where("size > 2").withColumn("parts", F.split("phrase", " "))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda s: F.array_join(F.slice(F.col("parts"), s, k), " "))))
    return longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language of ``docs`` (lang, text)."""
    counted, totals = frequencies(docs, least)
    rows = scored(counted, totals).join(subsumed(counted), ["lang", "phrase"], "left")
    kept = rows.where(F.col("around").isNull() | (100 * F.col("around") < SUBSUMED * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    numbered = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return numbered.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM w, (VALUES (1), (2), (3), (4), (5)) AS s(k), unnest(range(1, len(ws) - k + 2)) AS u(i)),
c AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
a AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f FROM c WHERE k > 1 AND f >= 100),
x AS (SELECT a.lang, a.phrase, a.f, cut, l.f AS l, r.f AS r, n.n, ((1000::HUGEINT * a.f * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM a, unnest(range(1, a.k)) AS u(cut), c l, c r, n
      WHERE n.lang = a.lang AND l.lang = a.lang AND r.lang = a.lang
        AND l.phrase = array_to_string(ws[1:cut], ' ') AND r.phrase = array_to_string(ws[cut + 1:], ' ')),
y AS (SELECT lang, phrase, min({'score': score, 'cut': cut, 'l': l, 'r': r, 'a': f, 'n': n}) AS v FROM x GROUP BY lang, phrase),
b AS (SELECT a.lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(f) AS around
      FROM a, (VALUES (2), (3), (4)) AS t(s), unnest(range(1, a.k - s + 2)) AS u(i) WHERE s < a.k GROUP BY 1, 2),
k AS (SELECT y.lang, y.phrase, v.a, v.l, v.r, v.n, v.score FROM y LEFT JOIN b ON b.lang = y.lang AND b.phrase = y.phrase WHERE around IS NULL OR 100 * around < 100 * v.a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k) WHERE rank <= 2000
"""

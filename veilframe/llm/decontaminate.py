"""Benchmark decontamination by the CGK embedding.

A random walk along a sequence of words copies it, staying on a word or moving on as a coin
for step and word says; sequences at a small edit distance give copies that agree in most
steps (Hamming distance).  Windows of an item's size are compared with items by sampling a
few steps of the copy as a key, repeated with other coins until the wanted recall is reached.
Whoever shares a key is verified: the exact edit distance in words between the item and the
best matching stretch around the window.

Only windows that can match are embedded.  An item of ``n`` words within ``k`` edits leaves
ceil((n - k) / (k + 1)) words in a row intact, so windows are laid where such a run of an item
stands, at the place the run has in the item; all texts are read in full.

Words are lower-cased and split at blanks and ASCII punctuation.  The items are sent to the
tasks in blocks of ``BLOCK``, so that any number of them is searched in bounded memory; the
documents are never shuffled.

Defined cases: null and empty texts have no words and match nothing; items of fewer than
``LEAST`` words tell no leak and match nothing; equal items are all reported; repeated rows are
reported each; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of the shortest item, and the share of an item's words that may be edited.
LEAST, EDITS = 5, 0.2
#: Steps sampled for a key; agreement of two copies and recall that set the number of repetitions.
SAMPLED, AGREE, RECALL = 3, 0.5, 0.95
#: Items that are searched at a time.
BLOCK = 5000
#: Characters that a task searches at a time.
AT_ONCE = 1 << 23
PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
SCHEMA = "array<struct<item_id: long, first_word: long, last_word: long, n_words: long, distance: long>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(PUNCTUATION).split()


def repetitions(recall: float = RECALL, agree: float = AGREE, sampled: int = SAMPLED) -> int:
    """Keys needed so that two copies that agree in ``agree`` of their steps share one with probability ``recall``."""
    return ceil(log(1 - recall) / log(1 - agree**sampled))


def _coin(rep: int, step: int, words: np.ndarray) -> np.ndarray:
    """0 or 1 for each word, the same in every process."""
    x = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64((rep * 65537 + step) * 0xBF58476D1CE4E5B9 % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(47)) & np.uint64(1)).astype(np.int64)


def embedded_keys(windows: np.ndarray, rep: int, sampled: int = SAMPLED) -> np.ndarray:
    """One key for each row of ``windows``: the copy's words at the sampled steps of walk ``rep``."""
    rows, n = windows.shape
    steps = np.sort(np.random.default_rng([rep, n]).choice(2 * n, size=min(sampled, 2 * n), replace=False))
    at, key = np.zeros(rows, np.int64), np.zeros(rows, np.uint64)
    padded = np.c_[windows, np.full(rows, -1)]
    for step in range(steps[-1] + 1):
        word = padded[np.arange(rows), at]
        if step in steps:
            key = key * np.uint64(0x100000001B3) + (word + 2).astype(np.uint64)
        at = np.minimum(at + _coin(rep, step, word + 1), n)
    return key


def closest(item: list[int], text: list[int]) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to a stretch of ``text``, and that stretch (end exclusive).

    Bit-parallel columns find distance and end; the same, reversed, finds the start.
    """
    best, end = _ends(item, text)
    _, back = _ends(item[::-1], text[:end][::-1], best)
    return best, end - back, end


def _ends(item: list[int], text: list[int], wanted: int | None = None) -> tuple[int, int]:
    masks: dict[int, int] = defaultdict(int)
    for k, w in enumerate(item):
        masks[w] |= 1 << k
    m, full, top = len(item), (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        if best == wanted:
            break
        eq = masks.get(w, 0) if w else 0
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq | minus
        ph, mh = (minus | ~(d | plus)) & full, plus & d
        score += (1 if ph & top else 0) - (1 if mh & top else 0)
        ph, mh = ((ph << 1) | (0 if wanted is None else 1)) & full, (mh << 1) & full
        plus, minus = (mh | ~(x | ph)) & full, ph & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """A block of items, indexed by their intact runs and by the keys of their walks."""

    def __init__(self, rows: list[tuple[int, str | None]], edits: float = EDITS, recall: float = RECALL):
        kept = [(i, w) for i, t in rows if len(w := words_of(t)) >= LEAST]
        self.words = {w: k + 1 for k, w in enumerate(sorted({x for _, ws in kept for x in ws}))}
        self.ids = [i for i, _ in kept]
        self.items = [[self.words[w] for w in ws] for _, ws in kept]
        self.most = [int(edits * len(x)) for x in self.items]
        self.reps = repetitions(recall)
        runs: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))  # by length and hash: place in the item, its length
        for x, k in zip(self.items, self.most, strict=True):
            q = ceil((len(x) - k) / (k + 1))
            for place, h in enumerate(_rolled(np.array(x), q).tolist()):
                runs[q][h].add((place, len(x)))
        self.runs = {q: (np.array(sorted(by), np.uint64), by) for q, by in runs.items()}
        by_size: dict[int, list[int]] = defaultdict(list)
        for k, x in enumerate(self.items):
            by_size[len(x)].append(k)
        self.keys: dict[int, list[dict[int, list[int]]]] = {}
        for n, members in by_size.items():
            rows_of = np.array([self.items[k] for k in members])
            self.keys[n] = []
            for rep in range(self.reps):
                table: dict[int, list[int]] = defaultdict(list)
                for k, key in zip(members, embedded_keys(rows_of, rep).tolist(), strict=True):
                    table[key].append(k)
                self.keys[n].append(dict(table))

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """Number of the text and of the item, distance, first and last (exclusive) word of the best match."""
        done = size = 0
        for k, text in enumerate(texts, 1):  # so many characters at a time, to bound the arrays
            size += len(text or "")
            if size >= AT_ONCE or k == len(texts):
                yield from ((done + f[0], *f[1:]) for f in self._search(texts[done:k]))
                done, size = k, 0

    def _search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        ids = [np.array([get(w, 0) for w in words_of(t)], np.int64) for get in [self.words.get] for t in texts]
        gap = np.zeros(max(map(len, self.items), default=0) + 1, np.int64)
        flat = np.concatenate([gap, *[x for i in ids for x in (i, gap)]])
        starts = np.cumsum([len(gap)] + [len(i) + len(gap) for i in ids])[:-1] if ids else np.empty(0, int)
        windows: dict[int, set[int]] = defaultdict(set)
        for q, (hashes, by) in self.runs.items():
            if len(flat) < q:
                continue
            rolled = _rolled(flat, q)
            whole = np.cumsum(np.r_[0, flat == 0])
            sure = np.flatnonzero(whole[q:] == whole[:-q])
            at = np.minimum(np.searchsorted(hashes, rolled[sure]), len(hashes) - 1)
            hit = sure[hashes[at] == rolled[sure]]
            for p, h in zip(hit.tolist(), rolled[hit].tolist(), strict=True):
                for place, n in by[h]:
                    windows[n].add(p - place)
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, places in windows.items():
            first = np.array(sorted(places))
            first = first[(first >= 0) & (first + n <= len(flat))]
            rows = flat[first[:, None] + np.arange(n)]
            pairs: set[tuple[int, int]] = set()
            for rep, table in enumerate(self.keys[n]):
                keys = embedded_keys(rows, rep)
                for r in np.flatnonzero(np.isin(keys, np.array(list(table), np.uint64))).tolist():
                    pairs.update((r, k) for k in table[int(keys[r])])
            for r, k in sorted(pairs):
                doc = int(np.searchsorted(starts, first[r] + n // 2, side="right")) - 1
                if doc < 0:
                    continue
                lo, hi = max(starts[doc], first[r] - self.most[k]), min(starts[doc] + len(ids[doc]), first[r] + n + self.most[k])
                if hi <= lo:
                    continue
                d, a, b = closest(self.items[k], flat[lo:hi].tolist())
                match = (d, int(lo + a - starts[doc]), int(lo + b - starts[doc]))
                if d <= self.most[k] and match < found.get((doc, k), (n + 1, 0, 0)):
                    found[doc, k] = match
        return ((doc, k, *match) for (doc, k), match in sorted(found.items()))


def _rolled(x: np.ndarray, q: int) -> np.ndarray:
    out = np.zeros(max(len(x) - q + 1, 0), np.uint64)
    for k in range(q):
        out = out * np.uint64(0x9E3779B97F4A7C15) + x[k : k + len(out)].astype(np.uint64)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, key: list[str], edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """``key`` columns of ``docs``, item_id, first_word, last_word (exclusive), n_words (of the item), distance.

    One row, the best match, for each row of ``docs`` and item whose distance is at most
    ``edits`` of the item's words.
    """
    found = [_search(docs, items, key) for items in _blocks(benchmark, edits, recall)]
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    for items in _blocks(benchmark, edits, recall):
        docs = docs.where(_holds_none(items)("text"))
    return docs


def _holds_none(items: Items):
    @F.pandas_udf("boolean")
    def holds_none(texts: pd.Series) -> pd.Series:
        hit = {f[0] for f in items.search(texts.tolist())}
        return pd.Series([k not in hit for k in range(len(texts))])

    return holds_none


def _blocks(benchmark: DataFrame, edits: float, recall: float) -> Iterator[Items]:
    """The items, at most BLOCK at a time on the driver; one empty block if there are none."""
    rows = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator()
    block = list(islice(rows, BLOCK))
    yield Items([(r["item_id"], r["text"]) for r in block], edits, recall)
    while block := list(islice(rows, BLOCK)):
        yield Items([(r["item_id"], r["text"]) for r in block], edits, recall)


def _search(docs: DataFrame, items: Items, key: list[str]) -> DataFrame:
    @F.pandas_udf(SCHEMA)
    def search(texts: pd.Series) -> pd.Series:
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for doc, k, distance, first, last in items.search(texts.tolist()):
            n = len(items.items[k])
            out[doc].append({"item_id": items.ids[k], "first_word": first, "last_word": last, "n_words": n, "distance": distance})
        return pd.Series(out)

    return docs.select(*key, F.inline(search("text")))

"""Tokens of two tokenizers aligned by the bytes they stand for, and counts of linked ids over the corpus.

Where tokens A and B of a text end at the same byte, the two are linked, and the text is cut into groups.
Most groups are one token of either with the same bytes: for those a table made once from the
vocabularies names the B id of each A id, and they are counted in a vector as long as the A
vocabulary.  Only links of the other, irregular groups are shuffled as pairs.

Of two linked tokens one's bytes end with the other's, since both end at the same place of one
text.  So the pairs that can ever be linked follow from the two vocabularies (``universe``,
some hundred thousand), whatever the corpus.  That bounds the table of counts that comes to the driver and
goes to the tasks; a text's links are kept as places in it.

Defined cases: a text that is null, empty or not given back by the bytes of either tokenizer has
no tokens; special tokens' strings are plain text; a null id is passed on; repeated rows count
each; an empty table gives no row; columns of ``docs`` beyond doc_id and text don't matter.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import batches_of, pack, stored, unpack

#: Folder of the vocabularies, and their names in it.
FOLDER, A, B = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters from which on a text is encoded in parts, characters that are encoded and texts that a task holds at a time.
PART, AT_ONCE, TEXTS = 1 << 16, 1 << 20, 500
#: What byte-level vocabularies of this kind split a text by before they merge bytes, and what is left to the first library:
#: runs so long that matching or merging them elsewhere could take more than linear time.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = re.compile(r"\S{500}|\s{100}")
#: Between two letters both tokenizers begin a new token with the blank; a long text can be cut there.
CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, as letter: byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Alignment:
    """The two tokenizers and the tables made from their vocabularies."""

    def __init__(self, folder: str, a: str, b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(os.path.join(folder, a)), sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, b))
        self.a.encode_special_tokens = True
        letters, entries = byte_letters(), {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in (entries.get(i, "") for i in range(max(entries) + 1))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.by_rank = self._by_rank()
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))

        a_ids, b_ids = defaultdict(list), defaultdict(list)
        for ids, table in ((a_ids, self.a_bytes), (b_ids, self.b_bytes)):
            for i, t in enumerate(table):
                ids[t].append(i)
        same = [b_ids[t][0] if t in b_ids else -1 for t in self.a_bytes]
        pairs = {self.code(i, k) for i, t in enumerate(self.a_bytes) for s in range(len(t)) for k in b_ids.get(t[s:], ())}
        pairs |= {self.code(i, k) for k, t in enumerate(self.b_bytes) for s in range(1, len(t)) for i in a_ids.get(t[s:], ())}
        #: All pairs that can be linked, by code; the place of each A id's pair with the same bytes, and that B id.
        self.universe = np.array(sorted(pairs), np.int64)
        self.same = np.array(same, np.int64)
        self.same_place = np.where(self.same >= 0, np.searchsorted(self.universe, np.arange(len(same)) * len(self.b_bytes) + self.same), -1)
        #: Ids as they stand in a group, with the sign after them.
        n = self.ids = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [b"%d%s" % (i, sign) for sign in (b",", b"|", b";") for i in range(n)]

    def _by_rank(self):
        """The same merges by rank, several times as fast; None unless ids rise with the merges and the split is ``SPLIT``."""
        import tiktoken

        told = json.loads(self.a.to_str())
        kind, model, added = told["pre_tokenizer"] or {}, told["model"], {t["id"] for t in told["added_tokens"]}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        usual = kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind.get("add_prefix_space") and not told["normalizer"]
        if not usual or merged != sorted(merged) or model.get("dropout") or model.get("ignore_merges"):
            return None
        ranks = {t: i for i, t in enumerate(self.a_bytes) if t and i not in added}
        return tiktoken.Encoding("by rank", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        slow = [k for k, t in enumerate(texts) if self.by_rank is None or LONG_RUN.search(t)]
        out = dict(zip(slow, (e.ids for e in self.a.encode_batch_fast([texts[k] for k in slow], add_special_tokens=False)), strict=True)) if slow else {}
        return [out[k] if k in out else self.by_rank.encode_ordinary(t) for k, t in enumerate(texts)]

    def code(self, i, k):
        return i * len(self.b_bytes) + k

    def b_of(self) -> np.ndarray:
        """The B id of each pair of the universe."""
        return self.universe % len(self.b_bytes)

    def parts(self, text: str) -> list[str]:
        """``text`` cut at blanks between letters into parts of ``PART`` characters or little more; the blanks are left out."""
        out, start = [], 0
        while self.cuttable and len(text) - start > PART and (m := CUT.search(text, start + PART)):
            out.append(text[start : m.start()])
            start = m.end()
        return [*out, text[start:]]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids A and B of each text; a part stands for itself with a blank before it in both."""
        parts = [self.parts(t) for t in texts]
        flat = [p for ps in parts for p in ps]
        a = self._ids_a([" " + p for p in flat])
        b = self.b.encode(flat, num_threads=1)
        ends = np.cumsum([len(ps) for ps in parts])
        joined = lambda ids, s, e: np.array([i for k in range(s, e) for i in ids[k]] if e - s > 1 else ids[s], np.int64)
        bounds = list(zip(np.r_[0, ends[:-1]], ends, strict=True))
        return [joined(a, s, e) for s, e in bounds], [joined(b, s, e) for s, e in bounds]

    def align(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes] | None:
        """Places of all links in the universe, A ids of groups of the same bytes, places of the other groups' links, and the written groups."""
        data = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != data or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != data:
            return None
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        at = np.searchsorted(b_ends, a_ends)
        last_a = np.flatnonzero(b_ends[at] == a_ends)  # the last token of each group
        last_b = at[last_a]
        in_a, in_b = np.diff(np.r_[-1, last_a]), np.diff(np.r_[-1, last_b])
        regular = (in_a == 1) & (in_b == 1) & (self.same[a[last_a]] == b[last_b])
        places = np.where(regular, self.same_place[a[last_a]], 0)
        places[~regular] = np.searchsorted(self.universe, self.code(a[last_a[~regular]], b[last_b[~regular]]))
        order = np.empty(len(a) + len(b), np.int64)
        at_a = np.arange(len(a)) + np.repeat(np.r_[0, last_b[:-1] + 1], in_a)
        at_b = np.arange(len(b)) + np.repeat(last_a + 1, in_b)
        order[at_a], order[at_b] = a, b
        order[at_a[last_a]] += self.ids
        order[at_b[last_b]] += 2 * self.ids
        return places, a[last_a[regular]], places[~regular], b"".join(map(self.written.__getitem__, order.tolist()))[:-1]


@lru_cache(maxsize=2)
def alignment(folder: str = FOLDER, a: str = A, b: str = B) -> Alignment:
    return Alignment(folder, a, b)


_ROWS = "doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, place int, n long"
_COLUMNS = [c.split()[0] for c in _ROWS.split(", ")]
_EMPTY = (0, 0, 0, 0, "", b"")


def _counts(places: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({**dict.fromkeys(_COLUMNS[:-2]), "place": places, "n": n})


def encoded(docs: DataFrame, folder: str, a: str, b: str) -> DataFrame:
    """Rows of two kinds: the texts with their links, and counts of places of the universe."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = alignment(folder, a, b)
        regular = np.zeros(len(tables.a_bytes), np.int64)
        for batch in batches:
            start, texts = 0, [t or "" for t in batch["text"]]
            while start < len(texts):
                end, size = start + 1, len(texts[start])
                while end < len(texts) and (size := size + len(texts[end])) < AT_ONCE:
                    end += 1
                some, rows, same, other = texts[start:end], [], [], []
                for text, x, y in zip(some, *tables.encode(some), strict=True):
                    found = tables.align(text, x, y) if text else None
                    if found is None:
                        rows.append(_EMPTY)
                        continue
                    places, same_ids, other_places, groups = found
                    same.append(same_ids)
                    other.append(other_places)
                    links = pack(np.diff(np.sort(places), prepend=0))
                    rows.append((len(x), len(y), len(places), len(places), hashlib.sha256(groups).hexdigest(), links))
                done = pd.DataFrame(rows, columns=_COLUMNS[1:7], dtype=object)
                yield done.assign(doc_id=batch["doc_id"].to_numpy(object)[start:end].tolist(), place=None, n=None).astype(object)
                if same:
                    regular += np.bincount(np.concatenate(same), minlength=len(regular))
                    yield _counts(*np.unique(np.concatenate(other), return_counts=True))
                start = end
        found = np.flatnonzero(regular)
        yield _counts(tables.same_place[found], regular[found])

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, _ROWS)


def pair_counts(rows: DataFrame, folder: str = FOLDER, a: str = A, b: str = B) -> np.ndarray:
    """How often each pair of the universe is linked; at most one small row for each comes to the driver."""
    summed = rows.where("place IS NOT NULL").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(alignment(folder, a, b).universe), np.int64)
    out[summed["place"].to_numpy()] = summed["n"].to_numpy()
    return out


def id_pairs(rows: DataFrame, folder: str = FOLDER, a: str = A, b: str = B) -> DataFrame:
    """a_id, b_id, n of all linked pairs of ids, from what ``encoded`` returned."""
    tables = alignment(folder, a, b)
    known = rows.sparkSession.createDataFrame(pd.DataFrame({"at": np.arange(len(tables.universe)), "code": tables.universe}))
    summed = rows.where("place IS NOT NULL").groupBy("place").agg(F.sum("n").alias("n")).join(known, F.col("place") == F.col("at"))
    return summed.select(F.expr(f"code div {len(tables.b_bytes)}").alias("a_id"), (F.col("code") % len(tables.b_bytes)).alias("b_id"), "n")


def aligned(docs: DataFrame, folder: str = FOLDER, a: str = A, b: str = B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    with batches_of(spark, TEXTS):
        rows = stored(encoded(docs, folder, a, b), "links")
    counts, b_of = pair_counts(rows, folder, a, b), alignment(folder, a, b).b_of()
    highest = np.zeros(b_of.max(initial=0) + 1, np.int64)
    np.maximum.at(highest, b_of, counts)
    table = spark.sparkContext.broadcast((counts, counts == highest[b_of]))  # one entry for each pair of the universe

    @F.pandas_udf("n_best long, count_sum long")
    def of(links: pd.Series) -> pd.DataFrame:
        counts, best = table.value
        places = [np.cumsum(unpack(x)) for x in links]
        return pd.DataFrame({"n_best": [int(best[p].sum()) for p in places], "count_sum": [int(counts[p].sum()) for p in places]}, dtype=np.int64)

    found = rows.where("place IS NULL").withColumn("found", of("links"))
    doc_id = F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return found.select(doc_id, "n_a", "n_b", "n_groups", "n_links", "found.n_best", "found.count_sum", "groups_sha256")

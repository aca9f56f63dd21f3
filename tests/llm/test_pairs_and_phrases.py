"""Token alignment, collocations and the n-gram join against plain readings, and their edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from veilframe.llm import ngram_join, phrases, token_alignment
from veilframe.llm.queries import QUERIES

WORDS = [f"w{k}" for k in range(400)]
CLASHING = {"key": 1, "node": 2, "id": 3, "n": 4, "chunk": 5, "place": 6, "f": 7, "phrase": 8, "component": 9}
EDGES = [(None, None, None), (None, "no id here", "en"), (1, "", "en"), (2, " \t\n ", None), (3, "a b", "en"), (4, "A  b\n", "en"), (5, "a", "de"), (5, "a", "de"), (6, "ü" * 300, "fr")]


@pytest.fixture(scope="module")
def texts(sf_dir):
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())


def rows_of(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", *[F.lit(v).alias(c) for c, v in CLASHING.items()])


# The n-gram join


def plain_ngrams(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def plain_classes(texts, size=3, share=90):
    sets = {i: plain_ngrams(t, size) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= share * max(len(x), len(y)) and 100 * len(x & y) >= share * len(x | y) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_op13_against_all_pairs(spark, sf_dir, texts):
    rows = QUERIES["op13_ngram_join"](spark, sf_dir).collect()
    expected = plain_classes(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected and len(rows) == len(texts)
    assert len({c for _, c in expected.values()}) < len(texts)


@pytest.mark.parametrize("block", [512, 7])
@pytest.mark.parametrize(("size", "share"), [(3, 90), (1, 70)])
def test_join_of_families_about_the_limit(spark, monkeypatch, block, size, share):
    rng, texts = random.Random(block + size), []
    common = " ".join(rng.choices(WORDS, k=12))
    for k in range(16):  # families about the limit, some large; all texts share a passage
        base = rng.choices(WORDS, k=rng.randint(1, 160))
        for _ in range(50 if k < 2 else 7):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // (25 * size // 2 + 8)))):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words) + f" {common}" * rng.randint(0, 2))
    texts += ["", None, " \n", "one two", "One  two", "one two three", "three"]
    rng.shuffle(texts)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = ngram_join.join_classes(docs, size, share).collect()
    expected = plain_classes(dict(enumerate(texts)), size, share)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert 10 < len({c for _, c in expected.values()}) < len(texts) - 20


def test_join_edges(spark):
    rows = ngram_join.join_classes(rows_of(spark, EDGES)).collect()
    assert len(rows) == len(EDGES)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)
    assert got == Counter([(None, 0, None), (None, 1, None), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (5, 1, 5), (5, 1, 5), (6, 1, 6)])
    assert ngram_join.join_classes(rows_of(spark, EDGES).limit(0)).collect() == []


def test_filters_lose_no_pair():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.r_[x[rng.random(len(x)) < 0.96], rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)])
        if not len(y) or 100 * len(np.intersect1d(x, y)) < 90 * len(np.union1d(x, y)):
            continue
        levels = rng.integers(0, 9, ngram_join.BUCKETS).astype(np.uint8)
        p, q = (ngram_join.ordered(s, levels)[: ngram_join.prefix_length(len(s), 90)] for s in (x, y))
        shared = [(i, list(q).index(h)) for i, h in enumerate(p) if h in q]
        assert shared
        i, j = shared[0]
        assert min(len(x) - i, len(y) - j) * 190 >= 90 * (len(x) + len(y))
        left, right = (ngram_join._suffix(s.view(ngram_join.np.int64), ngram_join.histogram(w), at) for s, w, at in ((p, x, i), (q, y, j)))
        assert i + j + abs(left - right).sum() <= len(x) + len(y) - 2 * -(-90 * (len(x) + len(y)) // 190)


def test_a_pair_that_met_is_not_compared_again(spark, monkeypatch):
    """Two sets just below the limit share keys that nothing else holds; the first round settles them, in whatever order."""
    rng, given, linked = random.Random(5), [], ngram_join.linked
    base = [f"{w}x{k}" for k, w in enumerate(rng.choices(WORDS, k=300))]
    other = [f"y{k}" if k % 50 == 20 else w for k, w in enumerate(base)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other))], "doc_id long, text string")

    def counted(pairs, *args):
        given.append(pairs.distinct().count())
        return linked(pairs, *args)

    monkeypatch.setattr(ngram_join, "linked", counted)
    monkeypatch.setattr(ngram_join, "bucket_levels", lambda *_: np.zeros(ngram_join.BUCKETS, np.uint8))
    assert sorted(r.component_id for r in ngram_join.join_classes(docs).collect()) == [1, 2]
    assert given == [1, 0, 0]


def test_suffixes_of_many_prefixes():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) for n in (1, 40, 7)]
    whole, lengths = np.array([ngram_join.histogram(s) for s in sets]), np.array([1, 9, 3])
    keys = np.concatenate([s[:k] for s, k in zip(sets, lengths, strict=True)]).view(np.int64)
    got = ngram_join.suffixes(keys, np.cumsum(lengths) - lengths, np.repeat(np.arange(3), lengths), whole)
    assert got.tolist() == [ngram_join.histogram(s[at + 1 :]).tolist() for s, k in zip(sets, lengths, strict=True) for at in range(k)]


# Collocations


def plain_collocations(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for sign in ".,;:!?\x0b\x0c\r":
            text = text.replace(sign, "\n")
        for piece in text.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang or "und" if lang is None else lang] += len(words)
            for k in range(1, 6):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        gone = {p[i : i + k] for p, n in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * n >= 100 * f[p[i : i + k]]}
        scored = []
        for p, a in found.items():
            score, _, le, r = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), le, r))
        out += [(lang, k + 1, p.decode(), -a, le, r, totals[lang], -s) for k, (s, a, p, le, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 16, 1 << 22), (300, 1, 500)])
def test_phrases_against_plain_counts(spark, monkeypatch, sizes):
    for name, value in zip(("CHUNK", "DENSE", "FLUSH"), sizes, strict=True):
        monkeypatch.setattr(phrases, name, value)
    rng = random.Random(sizes[0])
    fixed = [rng.choices(WORDS[:30], k=rng.randint(2, 8)) for _ in range(20)]
    rows = []
    for _ in range(150):
        words, length = [], rng.choice([0, 5, 120])
        while len(words) < length:
            words += rng.choice(fixed) if rng.random() < 0.5 else rng.choices(WORDS[:60], k=2)
            words[-1:] = [words[-1] + rng.choice(["", "", "", ".", ",", "\n", "\r", "\t"])]
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice([" ", "  "]).join(words).replace("w1", "W1")))
    rows += [("en", None), ("en", ""), (None, "w1 W1 w1 w1. w1\x0bw1"), ("fr", "ß é")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(map(tuple, phrases.collocations(docs, least=12, top=40).collect()))
    expected = plain_collocations(rows, 12, 40)
    assert got == expected and max(len(r[2].split()) for r in got) == 5


def test_phrase_edges(spark):
    assert phrases.collocations(rows_of(spark, EDGES)).collect() == []
    assert phrases.collocations(rows_of(spark, EDGES).limit(0)).collect() == []
    rows = phrases.collocations(rows_of(spark, [(k, "a b", None) for k in range(200)])).collect()
    assert [tuple(r) for r in rows] == [("und", 1, "a b", 200, 200, 200, 400, 2000)]


def test_what_no_longer_phrase_can_hold_is_not_kept():
    units, words = np.array([5, 6, -1, 7, 8, 9, -1, 4]), np.array([1, 2, 3, 4, 5, 6, 7, 8])
    kept, after = phrases.extendable(units, words, 2)
    assert kept.tolist() == [5, 6, -1, 7, 8, 9, -1, -1] and after.tolist() == [-1, -1, 3, -1, -1, 6, 7, -1]
    for a, b in zip(phrases.pairs_of(units, words, 2), phrases.pairs_of(kept, after, 2), strict=True):
        assert a.tolist() == b.tolist()
    numbers = np.arange(-1, 5000)
    assert phrases.spread_out(phrases.squeeze(numbers)).tolist() == numbers.tolist()


def test_only_frequent_words_are_looked_up(spark, monkeypatch):
    """A chunk asks for the numbers of words that may be frequent, not of all it holds."""
    docs = spark.createDataFrame([("en", " ".join(f"a b r{k} s{k}" for k in range(300)))], "lang string, text string")
    sent, mapped = [], type(docs).mapInArrow

    def counted(df, f, schema):
        rows = mapped(df, f, schema)
        sent.append(rows.count())  # at once, since its files are removed later
        return rows

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    assert [tuple(r)[2:4] for r in phrases.collocations(docs).collect()] == [("a b", 300)]
    assert len(sent) == 1 and 2 <= sent[0] < 20


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**12
    counted = spark.createDataFrame([("x", "a", 1, big), ("x", "b", 1, big - 1), ("x", "a b", 2, big - 3)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("x", 2 * big)], "lang string, n long")
    (row,) = phrases.scored(counted, totals).collect()
    assert row.score == 1000 * (big - 3) * 2 * big // (big * (big - 1))


# Token alignment


def plain_alignment(texts):
    tables = token_alignment.alignment()
    out, links = {}, Counter()
    for i, text in texts.items():
        a = tables.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tables.b.encode(text) if text else []
        data = (" " + text).encode() if text else b""
        ends = []
        for ids, of in ((a, tables.a_bytes), (b, tables.b_bytes)):
            place, list_of = 0, []
            for t in ids:
                place += len(of[t])
                list_of.append(place)
            ends.append(list_of)
        if not text or b"".join(tables.a_bytes[t] for t in a) != data or b"".join(tables.b_bytes[t] for t in b) != data:
            out[i] = (0, 0, [], "")
            continue
        both, groups, pairs, x, y = set(ends[0]) & set(ends[1]), [], [], 0, 0
        for end in sorted(both):
            p, q = ends[0].index(end, x) + 1, ends[1].index(end, y) + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            pairs.append((a[p - 1], b[q - 1]))
            x, y = p, q
        links.update(pairs)
        out[i] = (len(a), len(b), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest())
    highest = Counter()
    for (_, b), n in links.items():
        highest[b] = max(highest[b], n)
    return {i: (na, nb, len(p), len(p), sum(links[x] == highest[x[1]] for x in p), sum(links[x] for x in p), h) for i, (na, nb, p, h) in out.items()}, links


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_op11_against_plain_alignment(spark, sf_dir, texts):
    rows = QUERIES["op11_token_alignment"](spark, sf_dir).collect()
    expected, links = plain_alignment(texts)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == expected and len(rows) == len(texts)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = token_alignment.id_pairs(token_alignment.encoded(docs, token_alignment.FOLDER, token_alignment.A, token_alignment.B))
    assert {(r.a_id, r.b_id): r.n for r in found.collect()} == dict(links)


def test_alignment_edges(spark, texts):
    odd = ["<|endoftext|> <s> </s> <unk>", "  two blanks  ", "▁already", "\x00\x01 nul", "é ﬁ ½", "中文 テスト 🎉🎉", " nbsp　wide", "<0x41> a", "\n\n\t x", "x" * 5000]
    rows = [*EDGES, *[(100 + k, t, "en") for k, t in enumerate(odd)], (200, "\n".join(texts.values()), "en")]
    got = token_alignment.aligned(rows_of(spark, rows)).collect()
    expected, _ = plain_alignment(dict(enumerate(t for _, t, _ in rows)))
    key = lambda r: (r.doc_id, *[r[c] for c in COLUMNS])
    assert Counter(map(key, got)) == Counter((r[0], *expected[k]) for k, r in enumerate(rows))
    assert sum(r.n_a == 0 for r in got) >= 2
    assert token_alignment.aligned(rows_of(spark, EDGES).limit(0)).collect() == []


def test_ids_are_those_of_the_given_vocabularies(texts, monkeypatch):
    tables = token_alignment.alignment()
    assert tables.by_rank is not None
    odd = ["a  b   c", " a 's 'll don 't I'M", "x\u00a0 y \u3000 z", "▁a ▁ b▁ c", "1 2 3.5 €9 %% $ -1 ½ Ⅷ ٣", "中 文 🎉 é ß e\u0301", "\x1c a \x85 b\x00", "q \t w \n e\r\n", "<s> </s> <0x41> <|endoftext|> x"]
    odd += ["x" * 3000, " " * 3000, "a" + " " * 500 + "b", "\n" * 300, "é" * 700]
    odd += ["".join(random.Random(k).choices("ab1é.'▁ \n\u00a0ǅ²ⅳ", k=200)) for k in range(300)]
    everything = [*filter(None, texts.values()), *odd]
    whole = [(tables.a.encode(" " + t, add_special_tokens=False).ids, tables.b.encode(t)) for t in everything]
    for part in (1 << 16, 500):
        monkeypatch.setattr(token_alignment, "PART", part)
        a, b = tables.encode(everything)
        assert [(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)] == whole

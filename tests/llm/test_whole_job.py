"""What the operators and stages would miss if they did less than the whole job."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veilframe.llm import classifier, line_dedup, near_copies, simhash, spotsigs

WORDS = [f"w{k}" for k in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table_of(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], SCHEMA)


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b) if a | b else True


def first_of_classes(texts):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            if find(a) != find(b) and alike(sets[a], sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [k for k in range(len(texts)) if find(k) == k]


@pytest.mark.parametrize("block", [512, 20])
def test_near_copies_against_all_pairs(spark, monkeypatch, block):
    rng, texts = random.Random(11), []
    for k in range(25):  # families about the limit, one of them large
        base = rng.choices(WORDS, k=rng.randint(3, 300))
        for _ in range(90 if k == 0 else 6):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 35))):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words))
    texts += ["", None, " \n", "one two", "One  two", "one two three"]
    rng.shuffle(texts)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    kept = near_copies.firsts(table_of(spark, texts)).collect()
    assert sorted(r.key_id for r in kept) == first_of_classes(texts)
    sets = [shingles(t) for t in texts]
    far = [1 for a in range(len(texts)) for b in range(a) if alike(sets[a], sets[b]) and (simhash.fingerprint(texts[a]) ^ simhash.fingerprint(texts[b])).bit_count() > 3]
    assert far  # pairs that links of three bits don't hold


def test_one_document_of_each_simhash_group_stays(spark):
    rng, texts = random.Random(15), ["", None, "one two", "One two"]
    for _ in range(12):
        base = rng.choices(WORDS, k=rng.randint(3, 200))
        texts += [" ".join(base), " ".join(base[:-1]), " ".join([*base, "end"]), " ".join(base)]
    rng.shuffle(texts)
    prints, root = [simhash.fingerprint(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    kept = corpus_pipeline.near_duplicates(spark, table_of(spark, texts), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root)) and len(kept) < len(texts) - 12


def test_classes_of_a_bucket_are_joined_through_any_member():
    rng = random.Random(12)
    for _ in range(30):
        base = rng.choices(WORDS, k=80)
        texts = [" ".join(rng.choice(WORDS) if rng.random() < 0.03 else w for w in base) for _ in range(30)]
        sets, classes = [shingles(t) for t in texts], [rng.randrange(20) for _ in texts]
        a, b = near_copies._joined([near_copies.shingles(t) for t in texts], near_copies.np.array(classes))
        assert all(alike(sets[i], sets[j]) for i, j in zip(a, b, strict=True))

        def parts(links, n=len(texts), classes=classes):
            root = list(range(n))
            for i, j in [*links, *[(i, classes.index(classes[i])) for i in range(n)]]:
                root = [root[j] if r == root[i] else r for r in root]
            return [root.index(r) for r in root]

        assert parts(zip(a, b, strict=True)) == parts([(i, j) for i in range(30) for j in range(i) if alike(sets[i], sets[j])])


def plain_cut(texts, words=50, lines=3):
    """What is left of ``texts`` (id: text): later runs of ``lines`` lines, and of fewer with over ``words`` words."""
    split = {i: t.split("\n") for i, t in texts.items()}
    gone, owner = {i: set() for i in texts}, {}
    for i in sorted(texts):
        owner.setdefault(texts[i], i)
    for depth in range(1, lines + 1):
        first = {}
        for i in sorted(split):
            for k in range(len(split[i]) - depth + 1):
                run = split[i][k : k + depth]
                if depth < lines and sum(len(x.split()) for x in run) <= words:
                    continue
                here = (i, k) if depth == lines else (owner[texts[i]], k)
                if first.setdefault(tuple(run), here) != here:
                    gone[i] |= set(range(k, k + depth))
    return {i: "\n".join(x for k, x in enumerate(split[i]) if k not in gone[i]) for i in texts if len(gone[i]) < len(split[i])}


def test_short_runs_of_many_words_are_cut(spark):
    rng = random.Random(13)
    line = lambda n: " ".join(rng.choices(WORDS, k=n))
    p, q, half, rest, fifty = line(51), line(80), line(30), line(21), line(50)
    texts = [
        f"{line(5)}\n{p}\n{line(5)}", f"{p}\n{line(9)}\n{p}", p, p, q, q, f"{line(4)}\n{q}", f"{half}\n{rest}\n{line(3)}",
        f"x\n{half}\n{rest}", f"{half}\ny\n{rest}", f"{fifty}\na", f"{fifty}\nb", "", "", f"{q}\nz\n{q}", f"{q}\nz\n{q}", f"{q}\nz\n{q}\nend",
    ]
    for _ in range(40):
        texts.append("\n".join(rng.choice([p, q, half, rest, fifty, "a", "b", line(2)]) for _ in range(rng.randint(1, 6))))
    texts = dict(enumerate(texts))
    rows = corpus_pipeline.lines(spark, table_of(spark, texts.values()), "").collect()
    expected = plain_cut(texts)
    assert {r.doc_id: r.text for r in rows} == expected and all(r.n_chars == len(r.text) for r in rows)
    assert expected[1] != texts[1] and 2 not in expected and expected[5] == q and 8 in expected and expected[8] == "x"
    assert expected[9] == texts[9] and expected[11] == texts[11]
    assert line_dedup.dedup_lines(table_of(spark, [p, f"{p}\na"])).where("text = 'a'").count() == 0  # the query's own rule


@pytest.mark.parametrize("text", ["Abcdefg" * 20, "abcdefG" * 20, "ÄÖx", "aB", "", "x" * 50])
def test_upper_case_counts_every_letter(text):
    share = classifier.shape_of(text, classifier.words_of(text))[0]
    assert share == pytest.approx(sum(c.isupper() for c in text) / max(len(text), 1))


def test_fingerprints_stand_for_whole_texts(spark):
    """No anchor in these texts; another half gives another fingerprint."""
    rng = random.Random(16)
    for n in (10, 40, 500):
        base = rng.sample(WORDS * 2, n)
        docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[: n // 2] + rng.sample(WORDS * 2, n - n // 2))), (3, None)], "doc_id long, text string")
        rows = {r.doc_id: r for r in spotsigs.against_edits(docs).collect()}
        assert 0.1 < rows[1].near_next < 0.6 and rows[2].near_edited < 1 and rows[1].fingerprint != rows[2].fingerprint
        assert rows[1].n_signatures >= 0.8 * n


@pytest.mark.parametrize("hot", [None, 7])
def test_neighbours_of_hot_ids(spark, hot):
    rng = random.Random(17)
    rows = [(hot, f"text {k}") for k in range(400)] + [(k, f"other {k}") for k in range(0, 1000, 3)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = spotsigs.with_next(docs)
    pairs = {r.text: r.next_text for r in got.collect()}
    chain, at = [], "other 0"
    while at not in chain:
        chain.append(at)
        at = pairs[at]
    assert at == "other 0" and len(chain) == len(rows) == len(pairs)  # one ring
    ids = dict((t, i) for i, t in rows)
    order = [ids[t] for t in chain]
    assert order == sorted(order, key=lambda i: (i is None, i or 0))
    parts = docs.select("doc_id", F.xxhash64("text").alias("tie")).withColumn("range", spotsigs._ranges(docs.select("doc_id", F.xxhash64("text").alias("tie")), 8))
    held = [r["count"] for r in parts.groupBy("range").count().collect()]
    assert max(held) < 0.25 * len(rows)


def test_passages_of_over_50_words_go_from_the_query(spark, sf_dir):
    line = lambda n, seed: " ".join(random.Random(seed).choices(WORDS, k=n))
    texts = [f"{line(51, 1)}\na", f"b\n{line(51, 1)}", f"{line(50, 2)}\na", f"{line(50, 2)}\nb", line(60, 3), line(60, 3), f"{line(30, 4)}\n{line(25, 5)}", f"c\n{line(30, 4)}\n{line(25, 5)}\nd"]
    df = line_dedup.dedup_lines(table_of(spark, texts), counts=("n", "gone"), min_words=line_dedup.MIN_WORDS)
    assert {r.doc_id: (r.text, r.gone) for r in df.collect()} == {k: (t, 0) for k, t in enumerate(texts)} | {1: ("b", 1), 5: ("", 1), 7: ("c\nd", 2)}


def test_near_pairs_cover_texts_without_spots(spark):
    rng = random.Random(14)
    base = rng.sample(WORDS, 200)
    texts = [base, ["another", "start", *base[2:]], [*base[:2], *rng.sample(WORDS, 200)]]
    df = spark.createDataFrame([(" ".join(t),) for t in texts], "text string")
    (pair,) = spotsigs.near_pairs(df).collect()
    assert pair.likeness > 0.9

"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veilframe.llm import classifier, decontaminate, licenses, line_dedup, mixing, preferences, simhash, spotsigs, suffix_dedup
from veilframe.llm.components import components
from veilframe.llm.secret_ledger import SecretLedger
from veilframe.llm.shared import running_total
from veilframe.session import scratch_path

WORDS = [f"w{k}" for k in range(400)]
LONG = " ".join(random.Random(3).choices(WORDS, k=60_000))
LINES = "a b c\nd e f\ng h i\nj k l"
ITEM = "the quick brown fox jumps over the lazy dog near the old river bank today"
#: doc_id, text, lang, source, n_chars
ROWS = [
    (None, None, None, None, None),
    (None, "no id here", "en", "s1", 10),
    (1, "", "en", "s1", 0),
    (2, None, "en", None, None),
    (3, LONG, "en", "s1", len(LONG)),
    (4, LONG, "de", "s2", len(LONG)),
    (5, LINES, "en", "s2", 23),
    (5, LINES, "en", "s2", 23),
    (6, LINES + "\nlast", "en", "s2", 28),
    (7, f"x y {ITEM} z", "en", "s3", 80),
    (7, "the same id, another text with password = abcdefgh", "en", "s3", 50),
    (8, "ü" * 300, "fr", "s3", 300),
    (9, " \t\n ", "fr", "s3", 4),
]
CLASHING = ("key_id", "key_hash", "pos", "rank", "fp", "component", "copies", "row_id", "row_hash", "join_id", "join_hash",
            "cut_runs", "kept_lines", "lines_total", "lines_gone", "hash", "n", "x", "s", "range", "scored_", "taken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 0, 0), (3, 1, 0), (5, 1, 0), (5, 1, 1), (None, 1, 0), (7, None, 0), (8, 1, None), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "w1"), (None, "no id")], "item_id long, text string")


def same_columns(df, docs):
    rows = df.collect()
    assert df.columns == docs.columns
    assert all(r[c] == f"mine {c}" for r in rows for c in CLASHING)
    return rows


def test_classifier(docs, labels):
    for known in (labels, labels.limit(0), labels.where("doc_id = 3")):
        model = classifier.train(docs, known)
        rows = classifier.classify(docs, model, ["doc_id"]).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.p_good <= 1 for r in rows)
    assert all(r.accepted for r in rows) and len(same_columns(classifier.accepted(docs, model), docs)) == len(ROWS)
    assert classifier.classify(docs.limit(0), classifier.train(docs.limit(0), labels), ["doc_id"]).collect() == []


def test_lines(docs):
    df = line_dedup.dedup_lines(docs)
    rows = same_columns(df, docs)
    got = sorted(((r.doc_id, r.text) for r in rows), key=str)
    expected = [(i, "last" if i == 6 else t) for i, t, *_ in ROWS]
    assert got == sorted(expected, key=str)  # the repeated row 5 is one row, and first
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_line_runs_inside_a_text(spark):
    text = "\n".join(["a", "b", "c", "x", "a", "b", "c", "d", "q", "q", "q", "q", "q"])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = line_dedup.dedup_lines(df, counts=("n", "gone")).collect()
    assert row.text == "a\nb\nc\nx\nd\nq" and (row.n, row.gone) == (13, 7)
    runs = line_dedup.later_runs(df).collect()
    assert {(r.start, r.end) for r in runs} == {(4, 7), (9, 13)}
    deep = line_dedup.suffix_intervals(spark.createDataFrame([(k, "\n".join("abcdefgh")) for k in range(3)], "doc_id long, text string"), 7)
    assert sorted((r.key_id, r.pos) for r in deep.collect()) == [(k, p) for k in range(3) for p in (0, 1)]


def test_simhash(docs):
    rows = simhash.near_duplicates(docs.select("doc_id", "text")).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 7)}
    assert by_id[1].fp == by_id[2].fp == by_id[9].fp == 0 and by_id[9].component_id == 1
    assert by_id[4].component_id == 3 and by_id[4].fp == by_id[3].fp != 0
    assert simhash.near_duplicates(docs.select("doc_id", "text").limit(0)).collect() == []


def test_simhash_links_random_and_hot(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(60)]
    prints = set(seeds) | {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for s in seeds for _ in range(6)}
    prints |= {seeds[0] ^ 1 << a ^ 1 << b for a in range(30) for b in range(30)}  # a bucket of hundreds
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(prints):
        for b in prints[k + 1 :]:
            if ((a ^ b) % (1 << 64)).bit_count() <= 3 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    for block in (4096, 50):
        simhash.BLOCK, kept = block, simhash.BLOCK
        try:
            got = {r.node: r.component for r in components(simhash.links(fps)).collect()}
        finally:
            simhash.BLOCK = kept
        assert {p: got.get(p, p) for p in prints} == {p: find(p) for p in prints}


def test_thresholds_by_dynamic_programming():
    costs = [{-1: 0, 0: 5, 1: 50}, {-1: 0, 0: 1, 1: 4}, {-1: 0, 0: 7, 1: 90}]
    assert simhash.allocate(costs, 1) == (16, [0, 1, 0])
    assert simhash.allocate(costs, -1) == (4, [-1, 1, -1])


def test_components_of_a_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a <> 99")
    links = links.union(spark.createDataFrame([(500, 500)], "a long, b long"))
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {k: 0 if k < 100 else 100 for k in range(201)} | {500: 500}


def test_running_total(spark):
    rows = spark.range(1000).select((F.col("id") % 97).alias("k"), F.lit(2).alias("n")).groupBy("k").agg(F.sum("n").alias("n"))
    got = {r.k: (r.n, r.before) for r in running_total(rows, ["k"], "n", "before").collect()}
    total = 0
    for k in range(97):
        assert got[k][1] == total
        total += got[k][0]


def test_mix(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert {r.source for r in rows} == {None, "s1", "s2", "s3"}
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * sum(r.size for r in rows)) < 1e-6
    assert mixing.mix(docs.limit(0)).collect() == []
    assert {r.taken for r in mixing.mix(docs.where("text IS NULL OR trim(text) = ''")).collect()} == {0}


def test_licenses(docs, spark):
    assert licenses.scan_licenses(docs, ["doc_id"]).collect() == []
    notice = licenses.TEMPLATES["MIT grant"]
    edited = notice.replace("free of charge", "at no cost").replace("Software", "Program")
    texts = [(1, f"x y z {edited} the end"), (2, f"{LONG} {notice}"), (3, notice[: len(notice) // 2]), (4, f"{notice} {notice}"), (None, None)]
    rows = licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), ["doc_id"]).collect()
    assert {r.doc_id: round(r.coverage, 1) for r in rows if r.license == "MIT grant"} == {1: 0.9, 2: 1.0, 4: 1.0}
    assert {r.doc_id: r.first_word for r in rows if r.license == "MIT grant"}[1] == 3


def test_alignment_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcdefghij") for _ in range(rng.randint(0, 30))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert len(licenses.align(list("abcde"), list("xabzcdey"))) == 5


def test_spotsigs(docs, spark):
    rows = spotsigs.against_edits(docs).collect()
    assert len(rows) == len(ROWS)
    long = [r for r in rows if r.doc_id in (3, 4)]
    assert long[0].fingerprint == long[1].fingerprint and {r.near_next for r in rows if r.doc_id == 3} == {1.0}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert spotsigs.against_edits(docs.limit(0)).collect() == []
    one = spark.createDataFrame([(1, "only the one text")], "doc_id long, text string")
    assert [(r.near_next, r.n_chars) for r in spotsigs.against_edits(one).collect()] == [(1.0, 17)]


def test_spotsigs_near_pairs(spark):
    rng = random.Random(9)
    texts = []
    for k in range(40):
        words = [w for _ in range(60) for w in ("the", *rng.choices(WORDS, k=3))]
        texts += [words, words[:-2] + ["the", "end"], words[: 150 if k % 2 else 230], words]
    texts = [" ".join(t) for t in texts] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    pairs = {(r.a, r.b): r.likeness for r in spotsigs.near_pairs(df).collect()}
    sets = {r.fp for r in spotsigs.fingerprint(df.na.fill(""), "text", "fp").collect()} - {""}
    expected = {}
    for a in sets:
        for b in sets:
            x, y = set(a.split(",")), set(b.split(","))
            if a < b and len(x & y) >= 0.8 * len(x | y):
                expected[a, b] = len(x & y) / len(x | y)
    assert pairs == expected and len(pairs) > 40


def test_secret_ledger(spark, docs):
    ledger = SecretLedger(spark, scratch_path(spark, "ledger"))
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    n_texts = len({t or "" for _, t, *_ in ROWS})
    assert ledger.scan(versions).count() == 3 * n_texts
    assert ledger.scan(versions).count() == 0  # nothing unseen
    rows = ledger.report(versions).collect()
    assert len(rows) == len(ROWS) and sum(r.n_assign for r in rows) == 1
    more = spark.createDataFrame([("new", "key AKIA" + "A" * 16), ("copy", LINES)], "path string, text string")
    assert ledger.scan(more).count() == 3
    assert {(r.path, r.n_access) for r in ledger.report(more).collect()} == {("new", 1), ("copy", 0)}
    assert SecretLedger(spark, scratch_path(spark, "ledger")).scan(versions.limit(0)).count() == 0


def test_leaks(docs, benchmark, spark):
    assert [tuple(r) for r in decontaminate.leaks(docs, benchmark, ["doc_id"]).collect()] == [(7, 1, 2, 17, 15, 0)]
    rows = same_columns(decontaminate.clean(docs, benchmark), docs)
    assert len(rows) == len(ROWS) - 1
    assert decontaminate.leaks(docs.limit(0), benchmark, ["doc_id"]).collect() == []
    assert len(decontaminate.clean(docs, benchmark.limit(0)).collect()) == len(ROWS)
    decontaminate.BLOCK, kept = 1, decontaminate.BLOCK
    try:  # items in blocks give the same
        twice = benchmark.union(benchmark.where("item_id = 1").withColumn("item_id", F.lit(9)))
        assert {tuple(r)[:2] for r in decontaminate.leaks(docs, twice, ["doc_id"]).collect()} == {(7, 1), (7, 9)}
        assert decontaminate.clean(docs, twice).count() == len(ROWS) - 1
    finally:
        decontaminate.BLOCK = kept


def test_recall_of_edited_items():
    rng = random.Random(4)
    items = [" ".join(rng.choices(WORDS, k=rng.randint(15, 60))) for _ in range(100)]
    search, texts, planted = decontaminate.Items(list(enumerate(items))), [], set()
    for k, item in enumerate(items):
        words = item.split()
        for _ in range(int(0.2 * len(words))):
            at, kind = rng.randrange(len(words)), rng.random()
            words[at : at + (kind < 0.7)] = [] if kind < 0.35 else [rng.choice(WORDS)]
        texts.append(" ".join(rng.choices(WORDS, k=100) + words + rng.choices(WORDS, k=100)))
        planted.add((k, k))
    found = {f[:2] for f in search.search(texts)}
    assert len(found & planted) >= 0.9 * len(planted) and found <= planted


def test_next_answers_skip_missing_ids(spark):
    rows = [(i, t, r, f"{r} {i} {t}") for i in (1, 5, 9, None) for t, r in ((0, "user"), (1, "assistant"))] + [(7, 0, "user", "no answer")]
    chosen, rejected = preferences.swapped_answers(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    got = {r.pair_id: r.text for r in rejected.where("role = 'assistant'").collect()}
    assert got == {1: "assistant 5 1", 5: "assistant 9 1", 9: "", None: ""} and chosen.count() == rejected.count() == len(rows)


def test_many_turns_of_one_number(spark):
    rows = [(1, None if k % 2 else 3, "user", f"{k:03}") for k in range(600)]
    df = spark.createDataFrame(rows, "pair_id long, turn long, role string, text string")
    out = preferences.preference_rows(df, df.where("text < '590'")).collect()
    order = sorted(rows, key=lambda r: (r[1] is None, r[3]))
    chosen = sorted((r for r in out if r.part != "rejected"), key=lambda r: r.start)
    assert [r.rendered.split("\n")[1].removesuffix("<|im_end|>") for r in chosen] == [r[3] for r in order]
    assert sum(r.part == "prompt" for r in out) == 295


def test_one_id_of_very_many_rows(docs, spark):
    many = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(9).cast("long").alias("n_chars"))
    both = many.union(docs.select(many.columns))
    known = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model, featured = classifier.co_train(both, known, ["doc_id"])
    assert featured.count() == both.count() and model.share == 0.5


def test_exchange_is_the_sum_over_all_documents(spark):
    """One round against a plain reading: every document that a view is sure of counts, in its group."""
    rng = random.Random(21)
    rows = []
    for k in range(900):
        good = rng.random() < 0.5
        words = rng.choices(WORDS[:40] if good else WORDS[30:70], k=30)
        rows.append((k, " ".join(words), rng.choice(["en", "de"]), ("good" if rng.random() < 0.97 else "bad") if good else "bad", 90))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    known = spark.createDataFrame([(k, int(set(t.split()) <= set(WORDS[:40])), 0) for k, t, *_ in rows if k < 300], "doc_id long, quality int, toxic int")
    model, featured = classifier.co_train(docs, known, ["doc_id"], 1)
    stored_rows = featured.withColumn("labelled", F.when(F.col("doc_id") < 300, F.col("doc_id")))
    to_text, to_meta = classifier._exchanged(stored_rows, model)
    frame = featured.where("doc_id >= 300").select("featured.*").toPandas()
    views = classifier.Views.of(frame)
    by_text, by_meta = (classifier._p(z) for z in model.logits(views))
    sure = (by_text >= classifier.SURE) | (by_text <= 1 - classifier.SURE)
    assert to_meta[3].sum() == sure.sum() > 100
    assert (to_meta[3] @ to_meta[1]).tolist() == pytest.approx(views.metas[sure].sum(0).tolist())
    assert to_meta[3] @ to_meta[2] == (by_text[sure] > 0.5).sum()
    sure = (by_meta >= classifier.SURE) | (by_meta <= 1 - classifier.SURE)
    words = sum((classifier.np.bincount(i, minlength=model.text.words) for i, s in zip(views.ids, sure, strict=True) if s), classifier.np.zeros(model.text.words))
    assert to_text[3].sum() == sure.sum() > 0 and (to_text[3] @ to_text[0]).tolist() == pytest.approx(words.tolist())


def test_preferences(spark):
    schema = "pair_id long, turn long, role string, text string"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", None), (2, 0, "user", ""), (3, 0, None, "x"), (None, None, "user", "n")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "why"), (2, 0, "user", ""), (2, 0, "user", None), (3, 0, None, "x"), (4, 0, "user", "alone")]
    rows = preferences.preference_rows(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()
    got = sorted(((r.pair_id, r.part, r.nth, r.loss_end is not None) for r in rows), key=str)
    expected = [
        (1, "prompt", 0, False), (1, "chosen", 1, True), (1, "rejected", 1, True), (1, "rejected", 2, False),
        (2, "prompt", 0, False), (2, "prompt", 1, False), (3, "prompt", 0, False), (4, "rejected", 0, False), (None, "chosen", 0, False),
    ]
    assert got == sorted(expected, key=str)
    whole = "".join(r.rendered for r in sorted(rows, key=lambda r: r.nth) if r.pair_id == 1 and r.part in ("prompt", "chosen"))
    (answer,) = [r for r in rows if r.pair_id == 1 and r.part == "chosen"]
    assert whole[answer.loss_start : answer.loss_end] == "yes<|im_end|>\n"
    none = spark.createDataFrame([], schema)
    assert preferences.preference_rows(none, none).collect() == []


def test_long_conversations_in_blocks(spark):
    turns = spark.range(1000).select(F.lit(1).alias("pair_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    rows = preferences.preference_rows(turns, turns.where("turn < 700")).collect()
    assert {(r.part, r.nth) for r in rows} == {("prompt" if k < 700 else "chosen", k) for k in range(1000)}
    ends = {r.nth: (r.start, r.end) for r in rows}
    assert all(ends[k][1] == ends[k + 1][0] for k in range(999))


def test_suffix_dedup(docs, spark):
    rows = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs).collect()}
    n = len(LONG)
    assert rows[3, n] == rows[4, n] == (n, 1)
    assert rows[8, 600] == (600, 1) and rows[1, 0] == rows[2, 0] == (0, 0)  # a run repeats itself
    assert suffix_dedup.remove_repeats(docs.limit(0)).collect() == []
    a, b = "".join(random.Random(6).choices("abcdef", k=199)), "x" * 5
    close = spark.createDataFrame([(1, a + b), (2, b + a), (3, a + "y" + a)], "doc_id long, text string")
    assert {r.n_removed for r in suffix_dedup.remove_repeats(close).collect()} == {0}
    longer = spark.createDataFrame([(1, "p" + a + "z"), (2, "q" + a + "z" + b)], "doc_id long, text string")
    assert [(r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(longer).collect()] == [(200, 1)] * 2


def test_long_texts_are_cut_without_loss():
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"ab", k=5000)), b"short", bytes(rng.choices(b"ab", k=700))]
    whole, kept = suffix_dedup.contexts_of(texts), suffix_dedup.PIECE
    suffix_dedup.PIECE = 1000
    try:
        starts = set()
        for which, offsets, pieces in suffix_dedup.blocks_of(texts):
            row, anchor, _, place = suffix_dedup.contexts_of(pieces)
            starts |= {(which[r], offsets[r] + (p >> 16) + k, h) for r, h, p in zip(row.tolist(), anchor.tolist(), place.tolist(), strict=True) for k in range((p & 255) + 1)}
    finally:
        suffix_dedup.PIECE = kept
    expected = {(r, (p >> 16) + k, h) for r, h, p in zip(whole[0].tolist(), whole[1].tolist(), whole[3].tolist(), strict=True) for k in range((p & 255) + 1)}
    assert starts == expected and len(expected) == 4801 + 501


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_and_stand_empty_tables(spark, docs, labels, benchmark, tmp_path, name, stage):
    sf_dir = str(tmp_path)
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    benchmark.write.parquet(f"{sf_dir}/benchmark.parquet")
    df = stage(spark, docs, sf_dir)
    rows = df.collect()
    assert df.columns[: len(docs.columns)] == docs.columns and len(df.columns) - len(docs.columns) == (name == "mix")
    assert all(r[c] == f"mine {c}" for r in rows for c in CLASHING)
    kept = [r.doc_id for r in rows]
    if name == "lines":
        assert len(rows) == len(ROWS) and {r.n_chars for r in rows if r.doc_id == 6} == {4}
    if name == "near_duplicates":
        near = (simhash.fingerprint(ROWS[6][1]) ^ simhash.fingerprint(ROWS[8][1])).bit_count() <= 3
        assert sorted(kept, key=str) == sorted([None, None, 3, 5, *([] if near else [6]), 7, 7, 8], key=str)
    if name == "decontamination":
        assert kept.count(7) == 1 and len(rows) == len(ROWS) - 1
    if name == "mix":
        assert set(kept) <= {r[0] for r in ROWS} and all(r[df.columns[-1]] in (1, 2) for r in rows)
    assert stage(spark, docs.limit(0), sf_dir).collect() == []

"""Quality classifier by co-training.

Two views see a document: its text (which telling words and word beginnings it holds, and its shape) and the
metadata of its page (source, language, length, lines).  Each is a logistic model.  In every
round both are fitted, calibrated on held-out labels, and give the documents without a label that
they are sure of to the other as pseudo-labels.  In the end the calibrated log-odds of both are
weighed on the held-out labels into one probability, which scores every document.

The features of all documents are computed once and written.  Labels are a bounded sample
(``LABELLED`` documents, the first by a hash of the id, so reruns agree), and so are the terms
(``VOCABULARY``, chosen on the labels that fit, not on those held out).  Pseudo-labels come from all other
documents: Spark scores them in each round and sums those that a view is sure of.  For the
metadata view, whose features are four choices, sums by these choices are all there is to know; for the
text view documents of one source, language and pseudo-label enter as their mean with their number as weight.
Only such sums and the labelled documents' numbers come to the driver, no text.  A document is good if
its quality is 1 and it isn't toxic.

Defined cases: a null text is empty, null metadata is a value of its own; labels without quality
or id are left out, a null toxic means 0; several labels of one id count as the worst; several rows of
one id are labelled by the first by text; labelled documents beyond the sample count as unlabelled; with no
labels, or labels of one kind, the probability is the share of good ones (1 without labels)
and nothing is learned; rows that repeat are scored each; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import batches_of, fresh, stored

#: Bounds of the labelled sample and of the terms.
LABELLED, VOCABULARY = 8000, 2000
#: Standard errors by which a term's share of good and other documents must differ.
TELLING = 4.3
#: Rounds of exchange, and how sure a view must be of a document that it gives.
ROUNDS, SURE = 3, 0.98
#: Texts that a task holds at a time.
TEXTS = 500
#: Share of the labelled sample that calibrates, as one in so many.
HELD_OUT = 4
#: Documents under this probability are rejected.
ACCEPT = 0.5
#: Lengths of word beginnings that are terms beside the words.
STEMS = (3, 4, 5)
TOKEN = re.compile(r"\w+")
#: Buckets that sources are hashed to.
SOURCES = 64


def words_of(text: str) -> Counter:
    return Counter(TOKEN.findall(text.lower()))


def terms_of(words: Counter) -> set[str]:
    """The words and their beginnings, so that endings never seen before count too."""
    return {*words, *(w[:k] + "*" for w in words for k in STEMS if len(w) > k)}


def shape_of(text: str, words: Counter) -> list[float]:
    """What the text looks like, as shares that don't depend on its length."""
    n, total = max(len(text), 1), max(sum(words.values()), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    marks = sum(not (c.isalnum() or c.isspace()) for c in set(text)) / 10
    return [
        sum(text.count(c) for c in set(text) if c.isupper()) / n,
        text.count("!") / total,
        (text.count("|") + text.count("#") + text.count("*") + text.count("%")) / total,
        text.count(".") / total,
        (n - sum(len(w) * c for w, c in words.items())) / n,
        len(words) / total,
        max(words.values(), default=0) / total,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(len(w) * c for w, c in words.items()) / total / 10,
        sum(c for w, c in words.items() if w.isdigit()) / total,
        marks,
        1.0 if total < 20 else 0.0,
    ]


SHAPES = 12
LENGTHS, LANGUAGES = 8, 16
#: Where the choices of the metadata view start: source, language, length and lines by order of magnitude.
STARTS = (0, SOURCES, SOURCES + LANGUAGES, SOURCES + LANGUAGES + LENGTHS)
META = SOURCES + LANGUAGES + 2 * LENGTHS


def meta_of(source: str | None, lang: str | None, n_chars: float | None, lines: int) -> list[int]:
    """The four choices, each from its own range of numbers; -1 for a length that is not given."""
    length = STARTS[2] + min(LENGTHS - 1, int(np.log2(max(n_chars, 1)) / 2)) if n_chars is not None and n_chars == n_chars else -1
    return [_bucket(source, SOURCES), STARTS[1] + _bucket(lang, LANGUAGES), length, STARTS[3] + min(LENGTHS - 1, int(np.log2(lines)))]


def dense_meta(choices: np.ndarray) -> np.ndarray:
    """One of each choice, as zeros and ones."""
    out = np.zeros((len(choices), META + 1))
    np.put_along_axis(out, choices.astype(np.int64) % (META + 1), 1, axis=1)  # -1 is the last column
    return out[:, :META]


def features(frame: pd.DataFrame, vocabulary: dict[str, int]) -> pd.DataFrame:
    """ids (numbers of the vocabulary's terms in each text), shape, and meta (the metadata's choices)."""
    rows = []
    for text, source, lang, n_chars in zip(frame["text"], frame["source"], frame["lang"], frame["n_chars"], strict=True):
        text = text or ""
        words = words_of(text)
        ids = sorted(v for w in terms_of(words) if (v := vocabulary.get(w)) is not None)
        rows.append((ids, shape_of(text, words), meta_of(source, lang, n_chars, text.count("\n") + 1)))
    return pd.DataFrame(rows, columns=["ids", "shape", "meta"])


@dataclass
class Views:
    """The features of some documents as the two views read them."""

    ids: list[np.ndarray]
    shapes: np.ndarray
    metas: np.ndarray

    @classmethod
    def of(cls, frame: pd.DataFrame) -> Views:
        ids = [np.asarray(i, np.int32) for i in frame["ids"]]
        shapes = np.array([np.asarray(x, float) for x in frame["shape"]]).reshape(len(frame), SHAPES)
        return cls(ids, shapes, dense_meta(np.array([np.asarray(x) for x in frame["meta"]]).reshape(len(frame), 4)))

    def take(self, places: np.ndarray) -> Views:
        return Views([self.ids[k] for k in places], self.shapes[places], self.metas[places])


def _bucket(value: str | None, n: int) -> int:
    """0 for null; the same in every process."""
    return 0 if value is None else 1 + sum((k + 1) * b for k, b in enumerate(str(value).encode())) % (n - 1)


@dataclass
class View:
    """A logistic model over word numbers and a dense block, with a calibration."""

    words: int
    dense: int
    w: np.ndarray = field(default=None)
    v: np.ndarray = field(default=None)
    mean: np.ndarray = field(default=None)
    scale: np.ndarray = field(default=None)
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, ids: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        out = ((dense - self.mean) / self.scale) @ self.v + self.bias
        return out + np.array([self.w[i].sum() for i in ids]) if self.words else out

    def score(self, ids: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of a good document."""
        return self.slope * self.raw(ids, dense) + self.shift

    def fit(self, ids: list[np.ndarray], dense: np.ndarray, y: np.ndarray, more: tuple[np.ndarray, ...] | None = None, steps: int = 200, rate: float = 0.05, decay: float = 1e-4) -> None:
        """Full-batch Adam with weight decay, from zero.

        ``more``: means of further documents as (words, dense, y, numbers of documents).  Together they weigh
        as much as the labelled ones at most.
        """
        n = len(y)
        far, block, labels_of, numbers = more if more is not None else (np.zeros((0, self.words)), np.zeros((0, self.dense)), np.zeros(0), np.zeros(0))
        weights = np.r_[np.ones(n), numbers * min(1.0, n / max(numbers.sum(), 1e-9))]
        whole, y = np.r_[dense, block], np.r_[y, labels_of]
        share = weights / weights.sum()
        self.mean = share @ whole
        self.scale = np.sqrt(share @ (whole - self.mean) ** 2) + 1e-6
        x, flat = (whole - self.mean) / self.scale, np.concatenate([np.empty(0, np.int32), *ids]) if self.words else np.empty(0, np.int32)
        row = np.repeat(np.arange(n), [len(i) for i in ids]) if self.words else np.empty(0, np.int64)
        theta = np.zeros(self.words + self.dense + 1)
        m, s = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            z = x @ theta[self.words : -1] + theta[-1]
            if self.words:
                z = z + np.r_[np.bincount(row, theta[flat], n), far @ theta[: self.words]]
            e = (_p(z) - y) * share
            words = np.bincount(flat, e[row], self.words) + e[n:] @ far if self.words else []
            g = np.concatenate([words, x.T @ e, [e.sum()]]) + decay * theta
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        self.w, self.v, self.bias = theta[: self.words], theta[self.words : -1], theta[-1]

    def calibrate(self, raw: np.ndarray, y: np.ndarray) -> None:
        self.slope, self.shift = _logistic(raw[:, None], y)


def _p(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and intercept by Newton's method."""
    x, scale = np.c_[x / (s := np.abs(x).max(0) + 1e-9), np.ones(len(x))], np.r_[s, 1]
    theta = np.zeros(x.shape[1])
    for _ in range(25):
        p = _p(x @ theta)
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(theta))
        theta -= np.clip(np.linalg.solve(h, x.T @ (p - y) + ridge * theta), -5, 5)
    return theta / scale


@dataclass
class Model:
    vocabulary: dict[str, int]
    text: View | None
    meta: View | None
    both: np.ndarray | None
    share: float

    def logits(self, views: Views) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log-odds by text and by metadata."""
        return self.text.score(views.ids, views.shapes), self.meta.score([], views.metas)

    def score(self, frame: pd.DataFrame) -> pd.DataFrame:
        """Probability that a document is good, by text, by metadata, by both, from its features."""
        if self.text is None:
            p = (np.full(len(frame), self.share),) * 3
        else:
            a, b = self.logits(Views.of(frame))
            p = _p(a), _p(b), _p(np.c_[a, b] @ self.both[:-1] + self.both[-1])
        return pd.DataFrame(dict(zip(("p_text", "p_meta", "p_good"), p, strict=True)))


COLUMNS = ["text", "source", "lang", "n_chars"]
_FEATURES = "ids array<int>, shape array<double>, meta array<int>"


def _featured(vocabulary: dict[str, int]):
    @F.pandas_udf(_FEATURES)
    def of(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        return features(pd.DataFrame({"text": text, "source": source, "lang": lang, "n_chars": n_chars}), vocabulary)

    return of(*COLUMNS)


def co_train(docs: DataFrame, labels: DataFrame, keep: list[str], rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model, and ``docs`` with the columns ``keep`` and the written features in a last column, ``featured``."""
    good = F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(good.alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)  # bounded
    held = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(HELD_OUT)) == 0
    chosen = stored(chosen.select(F.col("doc_id").alias("labelled"), "good", held.alias("held")), "labelled")

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    vocabulary = _telling_terms(texts.where("NOT held").groupBy("labelled", "good").agg(F.min("text").alias("text")))
    names = [f"c{k}" for k in range(len(keep))]
    kept = [F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)]
    rows = docs.select(*kept, F.col("doc_id").alias("doc"), F.col("text").alias("first"), _featured(vocabulary).alias("featured"))
    rows = rows.withColumn("first", F.xxhash64("first"))
    with batches_of(docs.sparkSession, TEXTS):
        rows = stored(rows.join(F.broadcast(chosen), F.col("doc") == F.col("labelled"), "left"), "features")
    model = _fitted(rows, vocabulary, rounds)
    return model, rows.select(*names, "featured").toDF(*keep, "featured")


def _fitted(rows: DataFrame, vocabulary: dict[str, int], rounds: int) -> Model:
    one = F.min(F.struct("first", "featured")).alias("one")  # a row for each id
    sample = rows.where("labelled IS NOT NULL").groupBy("labelled", "good", "held").agg(one).select("labelled", "good", "held", "one.featured.*").toPandas()
    sample = sample.sort_values("labelled").reset_index(drop=True)
    y, held = sample["good"].astype(float).to_numpy(), sample["held"].astype(bool).to_numpy()
    if len(np.unique(y)) < 2:
        return Model(vocabulary, None, None, None, float(y.mean()) if len(y) else 1.0)
    if len(np.unique(y[held])) < 2 or len(np.unique(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    views = Views.of(sample)
    fit, hold = np.flatnonzero(~held), np.flatnonzero(held) if held.any() else np.arange(len(y))
    some, others = views.take(fit), views.take(hold)
    model = Model(vocabulary, View(len(vocabulary), SHAPES), View(0, META), None, float(y.mean()))
    to_text = to_meta = None
    for k in range(max(rounds, 1)):
        model.text.fit(some.ids, some.shapes, y[fit], to_text)
        model.meta.fit([], some.metas, y[fit], to_meta)
        model.text.calibrate(model.text.raw(others.ids, others.shapes), y[hold])
        model.meta.calibrate(model.meta.raw([], others.metas), y[hold])
        if k + 1 < rounds:
            to_text, to_meta = _exchanged(rows, model)
    model.both = _logistic(np.c_[model.logits(others)], y[hold])
    return model


def _exchanged(rows: DataFrame, model: Model) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """What each view gives to the other: means, pseudo-labels and numbers of all unlabelled documents it is sure of.

    A task adds up its documents by receiving view, pseudo-label and group (source and language, or all four
    choices); Spark adds up the tasks.  What comes to the driver is bounded by the choices there are.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[str, int, int], np.ndarray] = defaultdict(lambda: np.zeros(model.text.words + SHAPES + 1))
        counts: Counter = Counter()
        for batch in batches:
            views = Views.of(batch)
            by_text, by_meta = (_p(z) for z in model.logits(views))
            choices = np.array([np.asarray(x) for x in batch["meta"]]).reshape(len(batch), 4)
            for k in np.flatnonzero((by_text >= SURE) | (by_text <= 1 - SURE)):
                counts[int(by_text[k] > 0.5), int(_group(choices[k]))] += 1
            for k in np.flatnonzero((by_meta >= SURE) | (by_meta <= 1 - SURE)):
                total = totals["text", int(by_meta[k] > 0.5), int(_group(choices[k][:2]))]
                total[views.ids[k]] += 1
                total[-1 - SHAPES : -1] += views.shapes[k]
                total[-1] += 1
        out = [("meta", label, group, 0, float(n)) for (label, group), n in counts.items()]
        out += [(to, label, group, int(at), float(total[at])) for (to, label, group), total in totals.items() for at in np.flatnonzero(total)]
        yield pd.DataFrame(out, columns=["to", "label", "group", "at", "total"])

    unlabelled = rows.where("labelled IS NULL").select("featured.*")
    cells = unlabelled.mapInPandas(sums, "to string, label int, group long, at int, total double")
    frame = cells.groupBy("to", "label", "group", "at").agg(F.sum("total").alias("total")).toPandas().sort_values(["to", "label", "group", "at"])
    meta = frame[frame["to"] == "meta"]
    choices = np.array([_ungroup(g) for g in meta["group"]]).reshape(len(meta), 4)
    to_meta = (np.zeros((len(meta), 0)), dense_meta(choices), meta["label"].to_numpy(float), meta["total"].to_numpy())
    text = frame[frame["to"] == "text"]
    keys = text[["label", "group"]].drop_duplicates()
    place = {key: k for k, key in enumerate(map(tuple, keys.to_numpy()))}
    table = np.zeros((len(keys), model.text.words + SHAPES + 1))
    table[[place[key] for key in map(tuple, text[["label", "group"]].to_numpy())], text["at"].to_numpy()] = text["total"].to_numpy()
    means = table[:, :-1] / np.maximum(table[:, -1:], 1)
    words = model.text.words
    return (means[:, :words], means[:, words:], keys["label"].to_numpy(float), table[:, -1]), to_meta


def _group(choices: np.ndarray) -> int:
    """Choices as one number."""
    out = 0
    for c in choices:
        out = out * (META + 1) + int(c) + 1
    return out


def _ungroup(group: int) -> list[int]:
    return [int(group) // (META + 1) ** k % (META + 1) - 1 for k in (3, 2, 1, 0)]


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    return co_train(docs, labels, [], rounds)[0]


def _telling_terms(texts: DataFrame) -> dict[str, int]:
    """Terms whose share of documents differs most between the kinds, by standard errors; ``texts``: good, text."""

    @F.pandas_udf("array<string>")
    def terms(column: pd.Series) -> pd.Series:
        return pd.Series([sorted(terms_of(words_of(t or ""))) for t in column])

    n = {r["good"]: r["n"] for r in texts.groupBy("good").agg(F.count("*").alias("n")).collect()}
    bad_n, good_n = max(n.get(False, 0), 1), max(n.get(True, 0), 1)
    counted = texts.select("good", F.explode(terms("text")).alias("term")).groupBy("term").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    share = (F.col("g") + F.col("b")) / (bad_n + good_n)
    error = F.greatest(F.sqrt(F.greatest(share * (1 - share), F.lit(0.0)) * (1 / bad_n + 1 / good_n)), F.lit(1e-9))
    telling = counted.withColumn("z", F.abs(F.col("b") / bad_n - F.col("g") / good_n) / error).where(F.col("z") >= TELLING)
    return {r["term"]: k for k, r in enumerate(telling.orderBy(F.desc("z"), "term").limit(VOCABULARY).collect())}


def _scored(model: Model, featured: str = "featured"):
    """The probabilities, from a column of features."""

    @F.pandas_udf("p_text double, p_meta double, p_good double")
    def score(frame: pd.DataFrame) -> pd.DataFrame:
        return model.score(frame)

    return score(featured)


def classified(model: Model, featured: DataFrame) -> DataFrame:
    """What ``co_train`` returned, with p_text, p_meta, p_good and accepted instead of the features."""
    scored = featured.withColumn("featured", _scored(model))
    keep = [f"`{c}`" for c in featured.columns[:-1]]
    return scored.select(*keep, "featured.*", (F.col("featured.p_good") >= ACCEPT).alias("accepted"))


def classify(docs: DataFrame, model: Model, key: list[str]) -> DataFrame:
    """The columns ``key`` with p_text, p_meta, p_good and accepted, one row for each of ``docs``."""
    return classified(model, docs.select(*key, _featured(model.vocabulary).alias("featured")))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns."""
    (name,) = fresh(docs, "featured")
    featured = docs.withColumn(name, _featured(model.vocabulary))
    return featured.where(_scored(model, name)["p_good"] >= ACCEPT).drop(name)

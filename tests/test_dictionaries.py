"""Building name dictionaries."""

from pyspark.sql import functions as F

from veilframe.functions import word_lists as W
from veilframe.operators import dictionaries as D

WORDS = [
    "Anna", "anna", "A", "Ab", "AnnA", "McDonald", "MacDonald", "DeVito", "O'Brien", "D'Anna", "O’Brien", "Anne-Sophie",
    "Anne-sophie", "Anne-", "-Anne", "Anne--Sophie", "Anna2", "Anna Maria", "Éric", "Öz", "ÖZ", "Li-O", "ǅur", "Aか",
    "LaRue", "LaRUE", "Mc", "X'y", "", "'Anna", "Ŭna", "Iİ",
]


def python_name_word(word):
    """The definition, with Python's own string tests."""

    def ok(part):
        letters = part.replace("'", "").replace("’", "")
        return (
            part[:1].isupper()
            and letters.isalpha()
            and (letters[1:].islower() or part.startswith(W.INNER_CAPITAL_PREFIXES))
        )

    return len(word) >= 2 and all(map(ok, word.split("-")))


def words(spark, *items):
    return spark.createDataFrame([(w,) for w in items], "word string")


def listed(df):
    return sorted(r.word for r in df.collect())


def test_name_words(spark):
    rows = words(spark, *WORDS).select("word", D.is_name_word(F.col("word")).alias("ok")).collect()
    assert {r.word: r.ok for r in rows} == {w: python_name_word(w) for w in WORDS}


def test_labels_and_forms(spark):
    facts = [
        ("x1", "P31", "Q202444", None), ("x1", "P31", "Q12308941", None), ("x1", "label", "Anna", "de"),
        ("x1", "label", "Анна", "ru"), ("x2", "P31", "Q101352", None), ("x2", "label", "Berg", "de"),
        ("x2", "label", "Berg", "en"), ("x3", "label", "Nie", "de"),
        ("l1", "language", "Q188", None), ("l1", "lexicalCategory", "Q1084", None), ("l1", "lexicalForm", "f1", None),
        ("f1", "representation", "berg", None), ("l2", "language", "Q188", None),
        ("l2", "lexicalCategory", "Q147276", None), ("l2", "lexicalForm", "f2", None),
        ("f2", "representation", "Anna", None), ("l3", "language", "Q150", None),
        ("l3", "lexicalCategory", "Q1084", None), ("l3", "lexicalForm", "f3", None),
        ("f3", "representation", "mot", None), ("l2", "lexicalCategory", "Q24905", None),
    ]
    triples = spark.createDataFrame(facts, "s string, p string, o string, lang string")
    assert listed(D.labels_of(triples, W.GIVEN_CLASSES)) == ["Anna"]
    assert listed(D.labels_of(triples, W.SURNAME_CLASSES)) == ["Berg"]
    # a lexeme with a second category is kept for that one
    assert listed(D.word_forms(triples)) == ["Anna", "berg"]


def test_lists(spark):
    given = D.name_words_only(words(spark, "Anna", "Anna", "Rose", "rose", "Peter"))
    surnames = D.name_words_only(words(spark, "Berg", "Peter", "Zug", "Koch"))
    ordinary = D.ordinary_words(words(spark, "berg", "koch", "peter"), words(spark, "Zug", "Rose"))
    ambiguous = D.ambiguous_names(given, surnames, ordinary)
    assert listed(given) == ["Anna", "Peter", "Rose"]
    # Rose, Peter and Koch are well-known names
    assert listed(ambiguous) == ["Berg", "Zug"]
    merged = D.merge_lists(given, surnames, ambiguous, words(spark, "Der", "Berg"))
    rows = {r.word: (r.is_given, r.is_surname, r.is_ambiguous, r.is_stop) for r in merged.collect()}
    assert rows["Peter"] == (True, True, False, False)
    assert rows["Berg"] == (False, True, True, True)
    assert rows["Der"] == (False, False, False, True)
    counts = {r.list: r.n_words for r in D.list_counts(merged).collect()}
    assert counts == {"given_names": 3, "surnames": 4, "ambiguous_names": 2}


def test_fixed_lists():
    assert len(W.STOP_WORDS) == 173 and len(set(W.STOP_WORDS)) == 173
    assert {"Der", "Berg", "Haus", "Über"} <= set(W.STOP_WORDS)

"""The name rules: written-out examples, and random texts against brute force."""

import random
import re

import pytest
from brute_names import Brute
from pyspark.sql import functions as F

from veilframe.functions import name_patterns as P
from veilframe.functions.register import register_redact, register_redact_core
from veilframe.operators import lookup
from veilframe.operators.lexicon import NameLexicon, word_flags
from veilframe.operators.names import NAME_RULES
from veilframe.operators.redaction import redact, redact_names
from veilframe.plans.registry import document_words

CASES = [
    ("Herr Schmidt kam", "[TITLE] [LASTNAME1] kam"),
    ("Herr Der kam", "Herr Der kam"),
    ("Herr Reineke kam", "[TITLE] [LASTNAME1] kam"),
    ("Frau Dr. Anna Schmidt", "[TITLE] [TITLE] [GIVENNAME1] [LASTNAME1]"),
    ("Frau Dr. med", "[TITLE] [LASTNAME1]. med"),
    ("Bruder Anselm und Bruder Anna", "Bruder Anselm und [TITLE] [GIVENNAME1]"),
    ("Herr Peter, Herr Anna", "[TITLE] [LASTNAME1], [TITLE] [GIVENNAME1]"),
    ("Vorname: Anna", "Vorname: [GIVENNAME1]"),
    ("Vorname: Der Xyz", "Vorname: [GIVENNAME1] [GIVENNAME2]"),
    ("Zweiter Vorname: Maria", "Zweiter Vorname: [GIVENNAME2]"),
    ('"givenname3": "Anna Maria"', '"givenname3": "[GIVENNAME3] [GIVENNAME4]"'),
    ("Dritter Nachname: Xyz", "Dritter Nachname: [LASTNAME3]"),
    ("Name: Projekt Alpha", "Name: Projekt Alpha"),
    ("Name: Projekt Anna", "Name: [GIVENNAME1] [GIVENNAME2]"),
    ("\u212aunde: Anna, \u212aommentar von Anna", "\u212aunde: [GIVENNAME1], \u212aommentar von [GIVENNAME1]"),
    ("\u017furname: Xyz. T\u0130tel: Dr.", "\u017furname: [LASTNAME1]. T\u0130tel: Dr."),
    ("Name: Herr Schmidt", "Name: [TITLE] [LASTNAME1]"),
    ("Titel: Dr. Prof.", "Titel: [TITLE] [TITLE]"),
    ("<title>Mein Text</title> <Title>Mein</Title>", "<title>Mein Text</title> <Title>[TITLE]</Title>"),
    ("Mein Nachname ist Xyz", "Mein Nachname ist [LASTNAME1]"),
    ("my first name is Xyz Abc", "my first name is [GIVENNAME1] Abc"),
    ("ich heiße Xyz", "ich heiße [GIVENNAME1]"),
    ("Kommentar von Anna Schmidt", "Kommentar von [GIVENNAME1] [LASTNAME1]"),
    ("written by Plan", "written by Plan"),
    ("Liebe Anna, lieber Peter", "Liebe [GIVENNAME1], lieber Peter"),
    ("Viele Grüße\n\nAnne-Sophie Schmidt", "Viele Grüße\n\n[GIVENNAME1] [LASTNAME1]"),
    (r"Best regards,\nAnna", r"Best regards,\n[GIVENNAME1]"),
    ("gez. Schmidt", "gez. [LASTNAME1]"),
    ('["Royer Pasquot"]', '["[GIVENNAME1] [LASTNAME1]"]'),
    ('{"Anna": 1, "x": "Anna"}', '{"Anna": 1, "x": "[GIVENNAME1]"}'),
    ("x,Schmidt,y,Anna", "x,[LASTNAME1],y,[GIVENNAME1]"),
    ("|Anna|Schmidt|", "|[GIVENNAME1]|[LASTNAME1]|"),
    ("|Jo|Jo Li|Haus|Plan|", "|Jo|[GIVENNAME1] [LASTNAME1]|Haus|Plan|"),
    (", Vater, <em>Dame</em>", ", [TITLE], <em>[TITLE]</em>"),
    ("- Anna Schmidt\n1. Peter\r\n* Plan", "- [GIVENNAME1] [LASTNAME1]\n1. [GIVENNAME1]\r\n* Plan"),
    ("a\rAnna", "a\rAnna"),
    ("wie Anna von Schmidt sagte", "wie [GIVENNAME1] von [LASTNAME1] sagte"),
    ("wie Anna von der Schmidt sagte", "wie [GIVENNAME1] von der [LASTNAME1] sagte"),
    ("Das sagte Foo Anna Plan Xy", "Das sagte Foo [GIVENNAME1] [LASTNAME1] Xy"),
    ("dann Rose Plan sagte", "dann Rose Plan sagte"),
    ("Anna McDonald AnnaX", "Anna McDonald AnnaX"),
    ("a﷐b﷑c﷒d Herr Schmidt﷓﷒﷕", "a﷐b﷑c﷒d [TITLE] [LASTNAME1]﷓﷒﷕"),
    ("", ""),
    (None, None),
]

PIECES = [
    "Anna", "Maria", "Anne-Sophie", "Anne-Haus", "Schmidt", "Royer", "Peter", "Haus", "Plan", "Rose", "Berg", "Der",
    "Jo", "Li", "Xyz", "Zug-Anna", "O'Brien", "McDonald", "AnnaX", "Plan-Schmidt", "Der-Anna", "xAnna-Maria", "Anna'-Peter",
    "von", "von der", "der", "la", "Herr", "Frau", "Dr.", "Dr", "Graf", "Vater", "Mrs", "Herrn",
    "Titel:", "<title>", "</title>", "Vorname:", '"last_name2": "', "zweiter Vorname = ", "Name:", "Kunde: ", "name>",
    "Mein Name ist", "my last name is", "Kommentar von", "written by", "Hallo", "Liebe", "Sehr geehrter",
    "Viele Grüße,\n", "regards\\n", "gez.", '"', "'", ",", "|", ";", "[", "]", "(", ")", "{", "}", ":", "**", "<b>",
    "</b>", "\\\"", "\\n", "\n", "\r\n", "\t", "- ", "1. ", "•", "und", "sagte", ".", "-", "[TITLE]",
    "[GIVENNAME1]", "﷐", "﷑", "﷒",
]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    for _ in range(n):
        pieces = rng.choices(PIECES, k=rng.randint(2, 25))
        yield "".join(piece + rng.choice(["", " ", " ", " ", "  "]) for piece in pieces)


@pytest.fixture(scope="module", params=["shared", "joined"])
def lexicon(request, name_words):
    if request.param == "shared":
        return NameLexicon(name_words)
    return NameLexicon(name_words, max_shared_bytes=0)


def test_kinds_of_lexicon(name_words):
    assert NameLexicon(name_words).variable and not NameLexicon(name_words, max_shared_bytes=0).variable


def test_examples(spark, lexicon):
    df = spark.createDataFrame(CASES, "text string, expected string")
    rows = redact_names(df, "text", lexicon).collect()
    assert len(rows) == len(CASES)
    assert [(r.text, r.expected, r.redacted) for r in rows if r.redacted != r.expected] == []


def test_random_texts_against_brute_force(spark, lexicon, name_words):
    brute = Brute({r.word: r.flags for r in word_flags(name_words).collect()})
    texts = list(random_texts(3000))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = redact_names(df, "text", lexicon).collect()
    assert len(rows) == len(texts)
    wrong = [(r.text, brute.redact(r.text), r.redacted) for r in rows if brute.redact(r.text) != r.redacted]
    assert wrong[:3] == [] and sum(r.text != r.redacted for r in rows) > 1000


def test_copies_of_one_text_are_all_redacted(spark, lexicon):
    text = "wie Anna Schmidt sagte"
    df = spark.range(500).select("id", F.lit(text).alias("text"))
    counts = redact_names(df, "text", lexicon).groupBy("redacted").count().collect()
    assert [(r.redacted, r["count"]) for r in counts] == [("wie [GIVENNAME1] [LASTNAME1] sagte", 500)]
    only_text = redact_names(df.select("text"), "text", lexicon)
    assert only_text.columns == ["text", "redacted"] and only_text.count() == 500


def test_copies_that_meet_nothing(spark, lexicon):
    texts = ["", "nothing here", "Only Unlisted Words", None]
    df = spark.range(400).select("id", F.array(*map(F.lit, texts))[F.col("id").cast("int") % 4].alias("odd `name`"))
    redacted = redact_names(df, "odd `name`", lexicon)
    assert redacted.filter(F.col("`odd ``name```").eqNullSafe(F.col("redacted"))).count() == 400


def test_many_words_in_one_row(spark, name_words):
    """A row table with many buckets finds every word."""
    words = [f"Na{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(w, True, False, False, False) for w in words]
    lexicon = NameLexicon(spark.createDataFrame(rows, name_words.schema), stop_words=())
    df = spark.createDataFrame([(",".join(words),)], "text string")
    assert redact_names(df, "text", lexicon).first().redacted == ",".join(["[GIVENNAME1]"] * len(words))


def test_long_runs_finish(spark, name_words):
    """Long runs of anything a pattern repeats: no quadratic scan, no deep stack."""
    blanks = " " * 100_000
    runs = ["Herr " * 20_000, "Anna " + "la " * 50_000, "Ab" + "-Cd" * 20_000, "regards" + "\n" * 50_000, "Anna'" * 20_000]
    runs += [f"x\n{blanks}y", f'"{blanks}y', f"Name{blanks}y", f"Name:{blanks}y", f"Hallo{blanks}y", "1" * 100_000]
    runs += ["Frau Dr. " * 10_000, "Anna Schmidt " * 10_000, "|Anna" * 10_000]
    df = spark.createDataFrame([(r,) for r in runs], "text string").repartition(len(runs))
    redacted = redact_names(df, "text", NameLexicon(name_words)).collect()
    assert len(redacted) == len(runs)
    by_text = {r.text: r.redacted for r in redacted}
    assert by_text["|Anna" * 10_000] == "|[GIVENNAME1]" * 10_000
    assert by_text["Anna Schmidt " * 10_000] == "[GIVENNAME1] [LASTNAME1] [LASTNAME2] [LASTNAME3] " * 5_000


def test_whole_documents_against_brute_force(spark, sf_dir):
    """Whole documents with a dictionary made from their own words."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    entries = document_words(documents)
    brute = Brute({r.word: r.flags for r in word_flags(entries).collect()})
    rows = redact_names(documents, "text", NameLexicon(entries)).collect()
    assert len(rows) == documents.count() and sum(r.text != r.redacted for r in rows) > 20
    assert [r.doc_id for r in rows if brute.redact(r.text) != r.redacted] == []


def test_empty_dictionary(spark, name_words):
    lexicon = NameLexicon(name_words.limit(0))
    df = spark.createDataFrame([("Herr Anna und Anna Schmidt",)], "text string")
    assert redact_names(df, "text", lexicon).first().redacted == "[TITLE] [LASTNAME1] und Anna Schmidt"


def test_flags_of_a_word_are_merged(spark, name_words):
    twice = name_words.union(spark.createDataFrame([("Anna", False, True, False, False)], name_words.schema))
    assert {r.word: r.flags for r in word_flags(twice).collect()}["Anna"] == 3


def test_sql_functions(spark, name_words):
    lexicon = NameLexicon(name_words)
    register_redact(spark, lexicon)
    register_redact_core(spark)
    text = "Frau Anna Schmidt, am 05.01. um 10:00"
    row = spark.sql(f"SELECT redact('{text}') AS a, redact_core('{text}') AS b, redact(null) AS c").first()
    assert row.a == "[TITLE] [GIVENNAME1] [LASTNAME1], am [DATE] um [TIME]"
    assert row.b == "Frau Anna Schmidt, am 05.01. um [TIME]"
    assert row.c is None
    register_redact(spark, NameLexicon(name_words, max_shared_bytes=0), "redact_joined")
    texts = spark.createDataFrame([(k, t) for k, t in enumerate([text, text, None, "", "Herr Der kam"])], "k int, t string")
    texts.createOrReplaceTempView("some_texts")
    rows = spark.sql("SELECT k, redact(t) AS a, redact_joined(t) AS b FROM some_texts").collect()
    assert len(rows) == 5 and all(r.a == r.b for r in rows)


def test_redact_twice_gives_the_same(spark, name_words):
    """Wanted for tools that redact their own output."""
    lexicon = NameLexicon(name_words)
    df = spark.createDataFrame([(t,) for t, _ in CASES if t], "text string")
    twice = redact(redact(df, "text", lexicon, "once"), "once", lexicon, "twice")
    changed = twice.filter(F.col("once") != F.col("twice")).select("once", "twice").collect()
    # a title followed by another abbreviation, and a value that comes to stand alone
    assert len(changed) == 0


def test_no_text_shuffle_with_a_shared_dictionary(spark, name_words):
    plan = redact(spark.range(9).selectExpr("cast(id AS string) AS text"), "text", NameLexicon(name_words))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_stop_words_are_part_of_every_dictionary(spark):
    names = spark.createDataFrame([("Der", False, True), ("Schmidt", False, True)], "word string, is_given boolean, is_surname boolean")
    words = names.selectExpr("*", "false AS is_ambiguous", "false AS is_stop")
    texts = spark.createDataFrame([("Herr Der kam",), ("Herr Schmidt kam",)], "t string")
    for limit in (0, 1 << 20):
        with_list = redact(texts, "t", NameLexicon(words, max_shared_bytes=limit)).collect()
        assert [r.redacted for r in sorted(with_list)] == ["Herr Der kam", "[TITLE] [LASTNAME1] kam"]
        without = redact(texts, "t", NameLexicon(words, max_shared_bytes=limit, stop_words=["Schmidt"])).collect()
        assert [r.redacted for r in sorted(without)] == ["[TITLE] [LASTNAME1] kam", "Herr Schmidt kam"]


def test_joined_look_up_reads_the_text_once(spark, sf_dir, name_words):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("m", F.create_map("doc_id", "text"))
    shared = redact(documents, "text", NameLexicon(name_words))
    joined = redact(documents, "text", NameLexicon(name_words, max_shared_bytes=0))
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (shared, joined)]
    assert plans[1].count("regexp_replace(") <= plans[0].count("regexp_replace(")
    assert "documents.parquet" not in "".join(joined.inputFiles()) and "broadcast" not in plans[1].lower()
    assert joined.columns == shared.columns
    rows = [{r.doc_id: (r.m, r.redacted) for r in df.collect()} for df in (shared, joined)]
    assert rows[0] == rows[1]


def test_dropped_dictionary(spark, name_words):
    lexicon = NameLexicon(name_words)
    lexicon.drop()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(lexicon.path)


def test_flag_sql(spark):
    table = f"array('{lookup.EDGE}', '{lookup.EDGE}')"
    assert spark.sql(f"SELECT {lookup.flag(table, chr(39) + 'Anna' + chr(39))} AS f").first().f == lookup.EDGE


def _expanded(tree):
    """The strings of a parsed pattern without open loops."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "IN":
            more = [chr(a) for o, a in arg if str(o) == "LITERAL"]
        elif name == "BRANCH":
            more = [s for branch in arg[1] for s in _expanded(branch)]
        elif name == "SUBPATTERN":
            more = _expanded(arg[3])
        elif name in ("MAX_REPEAT", "POSSESSIVE_REPEAT"):
            more = ([""] if arg[0] == 0 else []) + (_expanded(arg[2]) if arg[1] else [])
        else:
            more = [""]
        out = [a + b for a in out for b in more]
    return out


@pytest.mark.parametrize(
    ("rule_id", "pattern", "folded"),
    [
        ("N3", P.GIVEN_LABEL, True), ("N4", P.LAST_LABEL, True), ("N5", P.FULL_LABEL, True), ("N6", P.NAME_PHRASE, True),
        ("N7", P.AUTHOR_PHRASE, True), ("N8", P.GREETING, False), ("N9", P.SIGNATURE, True),
    ],
)
def test_look_ahead_lets_every_phrase_start(rule_id, pattern, folded):
    first = next(rule.first for rule in NAME_RULES if rule.rule_id == rule_id)
    phrases = {p for p in _expanded(re._parser.parse(pattern)) if len(p) > 2}
    if folded:
        phrases |= {p.upper().replace("ẞ", "SS") for p in phrases if not p.startswith("gez")}
        phrases |= {p.replace("s", "ſ").replace("k", "K") for p in phrases if not p.startswith("gez")}
    assert len(phrases) >= 8 and [p for p in phrases if not re.match(first, p)] == []


def test_names_only_rules_need_no_more_than_the_table_says(spark):
    """A part of a hyphenated word counts though it is a stop word; ambiguous names and stop words alone don't."""
    rows = [("Zua", True, False, False, True), ("Zub", True, False, False, False), ("Zuc", True, False, True, False)]
    columns = "word string, is_given boolean, is_surname boolean, is_ambiguous boolean, is_stop boolean"
    lexicon = NameLexicon(spark.createDataFrame(rows, columns), stop_words=())
    cases = {
        "Hallo Zua-Zua da": "Hallo [GIVENNAME1] da",
        "Hallo Zua da": "Hallo Zua da",
        "Hallo Zuc da": "Hallo Zuc da",
        "wie Zub Zuc da": "wie [GIVENNAME1] [GIVENNAME2] da",
        "Hallo Xyz, gez. Xyz": "Hallo Xyz, gez. Xyz",
    }
    texts = spark.createDataFrame([(t,) for t in cases], "text string")
    assert {r.text: r.redacted for r in redact_names(texts, "text", lexicon).collect()} == cases

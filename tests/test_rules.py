"""The pattern rules, on written-out examples."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from veilframe.functions.regexes import exact_fold
from veilframe.functions.rules import CORE, FULL, RULES, java_pattern, select_rules
from veilframe.operators.redaction import redact_core, redact_patterns, redact_patterns_sql
from veilframe.plans.oracles import PLAIN

CASES = [
    # e-mail
    ("12.05.1990@gmail.com", "[EMAIL]"),
    ("05pierre-hugues.dunkl@tutanota.com", "[EMAIL]"),
    ("dünhaupt@aol.com", "[EMAIL]"),
    ("a@b.de.x@c.de", "[EMAIL][EMAIL]"),
    ("a@b@c.de", "a@[EMAIL]"),
    ("a@b.c1", "a@b.c1"),
    ("x@y..de", "x@y..de"),
    ("x@y.de-z", "[EMAIL]-z"),
    ("@y.de", "@y.de"),
    # licence and ID card
    ("Führerschein: M41348406", "Führerschein: [DRIVERLICENSE]"),
    ("FÜHRERSCHEIN: M41348406", "FÜHRERSCHEIN: [DRIVERLICENSE]"),
    (r"führerschein: M41348406", r"führerschein: [DRIVERLICENSE]"),
    ("T5-46-HLFZFTF-2", "[DRIVERLICENSE]"),
    ("B2 18 CJYFTWD 9, Q865UNULDLM2", "[DRIVERLICENSE], [DRIVERLICENSE]"),
    ("M41348406", "[IDCARD]"),
    ("RD7407623 VF58428VF QEB503078G Z2609487476600 13960813A O9745471G", " ".join(["[IDCARD]"] * 6)),
    ("Ausweisnummer: W5900073", "Ausweisnummer: [IDCARD]"),
    ('"id_card": "1129843465"', '"id_card": "[IDCARD]"'),
    ("W5900073", "W5900073"),
    # numbers
    ("Steuernummer: 67010143B907", "Steuernummer: [TAX_ID]"),
    ("St.-Nr. 12 345 678 901", "St.-Nr. [TAX_ID]"),
    ("<TaxpayerID>7331921667168", "<TaxpayerID>[TAX_ID]"),
    ("SV 72.16.10.63.B04.6", "SV [SOCIALNUMBER]"),
    ("41-27-05-46-K77-1, 35080239S156", "[SOCIALNUMBER], [SOCIALNUMBER]"),
    ("756.8319.4907.37 7568665471296", "[SOCIALNUMBER] [SOCIALNUMBER]"),
    ("2.64.04.37968.005.13", "[SOCIALNUMBER]"),
    ("669-09-2502, 642 50 3478, 255.57.3442", "[SOCIALNUMBER], [SOCIALNUMBER], [SOCIALNUMBER]"),
    ("669-09.2502", "669-09.2502"),
    ("Lye Ras 11 B 54 7 ZUM", "[SOCIALNUMBER]"),
    # addresses of machines
    ("7:57 fe80::1:23 ::1", "[TIME] [IP] [IP]"),
    ("IP 1.2.3.4.5", "IP 1.[IP]"),
    ("ends 10.1.2.3\n", "ends [IP]\n"),
    ("10.1.2.3.", "[IP]."),
    ("256.1.2.3", "256.1.2.3"),
    ("::ffff:192.168.1.1 fe80::", "[IP] [IP]"),
    ("a893:d59e:e7ef:4ec3:520d:1710:207:2b70", "[IP]"),
    ("std::abc", "std::abc"),
    ("::1 ::2", "[IP] [IP]"),
    # bank, date, time
    ("DE89 3704 0044 0532 0130 00", "[IBAN]"),
    ("DE89370400440532013000", "[IBAN]"),
    ("2064-01-05T10:00:00Z", "[DATE]"),
    ("1943-06-04T00:00:00 5. Januar 2064 5. Jan. 2064 Januar 2064", "[DATE] [DATE] [DATE] [DATE]"),
    ("05/01/2064 5.1.2064 2064-01-05 05.01.64 05-01-2064 2064/01/05", " ".join(["[DATE]"] * 6)),
    ("am 05.01. und 10.00 Uhr, 9-17 Uhr", "am [DATE] und [TIME] Uhr, 9-[TIME] Uhr"),
    ("14:30,7:57 12:36:41 21h", "[TIME],[TIME] [TIME] [TIME]"),
    ("29:30 a7:57", "29:30 a7:57"),
    # phone
    ("+49 (0)30 1234567", "[PHONE]"),
    ("+49 30 1234567, +49-57 643 4205, +4165941 4831", "[PHONE], [PHONE], [PHONE]"),
    ("0165-57634430, 075-656 6263, 0015.43664924", "[PHONE], [PHONE], [PHONE]"),
    ("(030) 1234567", "[PHONE]"),
    ("0745848267", "0745848267"),
    # postal address
    ("Hauptstraße 22, 10115 Berlin", "[ADDRESS]"),
    ("Ort: Köln Tel 030 1234567 x", "Ort: [ADDRESS]"),
    ("state: done", "state: [ADDRESS]"),
    ("<city>Magdeburg</city>", "<city>[ADDRESS]</city>"),
    ("**Bundesland:** Bayern", "**Bundesland:** [ADDRESS]"),
    ("<strong>Stadt:</strong> Halle", "<strong>Stadt:</strong> [ADDRESS]"),
    ("Maria-Montessori-Straße, Ratheimer Straße 5a", "[ADDRESS], [ADDRESS]"),
    ("Schauinslandweg 8 Heimweg", "[ADDRESS] Heimweg"),
    ("Am Weg 8, Weg 8, weg 8, Hofweg 12-Xweg 5a, Hofwege 3", "Am Weg 8, Weg 8, weg 8, [ADDRESS]-[ADDRESS], Hofwege 3"),
    ("Hauptstraßenbau Ratheimer Straßenbau-Xstraße 5", "[ADDRESS]nbau [ADDRESS]nbau-[ADDRESS]"),
    ("Hauptstraße 1 D-79117 Freiburg im Breisgau", "[ADDRESS]"),
    ("CİTY: x cıty: x", "CİTY: x cıty: x"),
    ("\u017ftadt: x, STRA\u1e9eE: y", "\u017ftadt: [ADDRESS], STRA\u1e9eE: [ADDRESS]"),
    ("", ""),
    (None, None),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(n, *c) for n, c in enumerate(CASES)], "n int, text string, expected string")


def differing(df, column="redacted"):
    return [(r.text, r.expected, r[column]) for r in df.collect() if r[column] != r.expected]


def test_examples(texts):
    assert differing(texts.withColumn("redacted", redact_patterns(F.col("text")))) == []


def test_sql_text_gives_the_same(texts):
    assert differing(texts.withColumn("redacted", F.expr(redact_patterns_sql("text")))) == []


def test_row_classes_change_nothing(texts):
    """The plain chain, every rule for every row."""
    col = F.col("text")
    for rule in RULES:
        col = F.regexp_replace(col, java_pattern(rule), rule.replacement)
    assert differing(texts.withColumn("redacted", col)) == []


def test_idempotent(texts):
    once = texts.withColumn("expected", redact_patterns(F.col("text")))
    assert differing(once.withColumn("redacted", redact_patterns(F.col("expected")))) == []


def test_core_profile(spark):
    df = spark.createDataFrame([("am 05.01. da",)], "text string")
    assert df.select(redact_core(F.col("text"))).first()[0] == "am 05.01. da"
    assert df.select(redact_patterns(F.col("text"))).first()[0] == "am [DATE] da"
    assert len(select_rules(CORE)) == 40 and len(select_rules(FULL)) == 41
    with pytest.raises(ValueError):
        select_rules("other")


def test_long_runs_finish(spark):
    """Long unbroken runs, as in junk pages: no quadratic scan, no deep stack."""
    blanks = " " * 100_000
    runs = ["a" * 200_000, "x@" + "a." * 50_000, "A-" * 2_000, "Ab" + "-Cd" * 20_000, "1." * 20_000, "la " * 50_000]
    runs += [f"city:{blanks}\nx", f"city: <b>{blanks}\n", f"1 Uhr{blanks}", "1:" * 50_000, "+1" * 50_000, "::" * 50_000]
    df = spark.createDataFrame([(r,) for r in runs], "text string").repartition(len(runs))
    assert df.select(F.length(redact_patterns(F.col("text"))).alias("n")).agg(F.count("n")).first()[0] == len(runs)


def random_joins(parts, joints, n=4000, longest=10, seed=3):
    rng = random.Random(seed)
    for _ in range(n):
        yield "".join(rng.choice(parts) + rng.choice(joints) for _ in range(rng.randint(1, longest)))


STREET_PARTS = ["Haupt", "Ratheimer", "Straße", "Straßenbau", "Foo", "bar", "strasse", "Str.", "Am", "Hofweg", "weg", "X"]
RANDOM_TEXTS = {
    "R1": (["a", "b1", "é", "_", ".", "..", "-", "+", "%", "@", "@", "a@b", ".de", ".de", " "], [""]),
    "R17": ([":", "::", "::", "a", "F0", "12345", "g", " ", ".", "é", "\n"], [""]),
    "R31": (["0", "1", "2", "9", ":", "1:59", "23:0", ":12", "5", "a", " ", ",", "٣", "é", "\n"], [""]),
    "R38": (["city", "Ort", "PLZ", ":", "=", ">", "<b>", "</b>", "x y", "\n", "*", '"', "'", ",", "[DATE]"], ["", " ", "\t"]),
    "R39": (STREET_PARTS, ["-", "-", "", " ", " 5", " 12a ", ", "]),
    "R40": (STREET_PARTS, ["-", "-", "", " ", " 5", " 12a ", ", "]),
}


def plain_form(rule):
    pattern, token = PLAIN.get(rule.rule_id, (rule.pattern, rule.replacement))
    return pattern.replace("*+", "*").replace("?+", "?"), token.replace("$1", r"\1")


@pytest.mark.parametrize("rule_id", list(RANDOM_TEXTS))
def test_tuned_patterns_equal_the_plain_ones(spark, rule_id):
    """The patterns tuned for Java against their plain form, in Python, on random texts."""
    (rule,) = [r for r in RULES if r.rule_id == rule_id]
    pattern, token = plain_form(rule)
    rows = [(t, regex.sub(pattern, token, t)) for t in random_joins(*RANDOM_TEXTS[rule_id])]
    df = spark.createDataFrame(rows, "text string, expected string")
    tuned = df.withColumn("redacted", F.regexp_replace("text", java_pattern(rule), rule.replacement))
    assert differing(tuned) == [] and tuned.filter("text <> redacted").count() > 100


def test_row_classes_on_random_texts(spark):
    """Leaving rules out by row class against running every rule on every row."""
    parts = [c[0] for c in CASES if c[0]] + ["Am", "Ort", "city", "x", "Straße", "abc@de.fr", "fe80::", "::"]
    texts = list(random_joins(parts, ["", " ", ", ", ": ", "\n"], longest=4))
    texts += [regex.sub(r"\p{Nd}", "", t) for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(8)
    col = F.col("text")
    for rule in RULES:
        col = F.regexp_replace(col, java_pattern(rule), rule.replacement)
    both = df.withColumn("expected", col).withColumn("redacted", redact_patterns(F.col("text")))
    assert differing(both) == []


def test_exact_fold():
    assert exact_fold("id") == "id"
    assert exact_fold(r"(?i:id\s)i") == r"(?i:(?-i:[iI])d\s)i"

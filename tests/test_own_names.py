"""The query over documents with a dictionary of their own words, against brute force."""

import re

import __spark_entry__ as entry_points
from brute_names import Brute
from veilframe.operators.lexicon import word_flags
from veilframe.operators.redaction import redact
from veilframe.plans.registry import document_words


def test_documents_with_own_names_against_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    brute = Brute({r.word: r.flags for r in word_flags(document_words(documents)).collect()})
    expected = {}
    for r in redact(documents.select("doc_id", "text"), "text").collect():  # pattern rules, then names
        text = brute.redact(r.redacted)
        found = re.findall(r"\[(GIVENNAME|LASTNAME)[0-9]*\]", text)
        expected[r.doc_id] = (found.count("GIVENNAME"), found.count("LASTNAME"), len(text))
    rows = entry_points.queries()["documents_with_own_names"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_given, r.n_last, r.length) for r in rows} == expected
    assert sum(e[0] + e[1] for e in expected.values()) > 0

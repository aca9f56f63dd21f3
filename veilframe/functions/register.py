"""Redaction as SQL functions of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from veilframe.functions.rules import CORE, FULL
from veilframe.operators.lexicon import NameLexicon
from veilframe.operators.lookup import EDGE, FLAG_DIGITS, entry, needed_words, row_table
from veilframe.operators.names import after_lookup, before_lookup, lookup_steps
from veilframe.operators.redaction import redact_patterns_sql


def _create(spark: SparkSession, name: str, body: str, params: str = "txt STRING", returns: str = "STRING") -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")


def register_redact_core(spark: SparkSession, name: str = "redact_core") -> None:
    """``redact_core(text)``: the pattern rules of the reduced profile."""
    _create(spark, name, redact_patterns_sql("txt", CORE))


_HITS = f"""collect_list(struct(xxhash64(word) AS h, {entry('word', f"substr('{FLAG_DIGITS}', flags + 1, 1)")} AS e))"""


def _looked_up(lexicon: NameLexicon, view: str) -> str:
    """The look-up table of ``txt`` as a subquery on the dictionary, which becomes the view ``view``."""
    lexicon.flags.createOrReplaceTempView(view)
    words = f"(SELECT explode({lexicon.words_to_join('txt')}) AS w) JOIN {view} ON word = w"
    return f"coalesce((SELECT {row_table(_HITS)} FROM {words}), array('{EDGE}'))"


def register_redact(spark: SparkSession, lexicon: NameLexicon, name: str = "redact") -> None:
    """``redact(text)``: all pattern rules, then the name rules.

    With a dictionary that is shared as a value, the look-up is an expression.  With a
    larger one it is a subquery on the dictionary's table, which Spark turns into joins
    on the distinct texts.
    """
    _create(spark, f"{name}_patterns", redact_patterns_sql("txt", FULL))
    _create(spark, f"{name}_titles", before_lookup(f"{name}_patterns(txt)"))
    lookup = needed_words("txt", lexicon.variable) if lexicon.variable else _looked_up(lexicon, f"{name}_words")
    _create(spark, f"{name}_lexicon", lookup, returns="ARRAY<STRING>")
    _create(spark, f"{name}_names", after_lookup(_create_steps(spark, name).replace("lex)", f"{name}_lexicon(txt))")))
    _create(spark, name, f"{name}_names({name}_titles(txt))")


def _create_steps(spark: SparkSession, name: str) -> str:
    """Create a function for each rule with look-ups; the call that runs all of them on ``txt`` with the look-up table ``lex``.

    Each step is a function over the one before: written as one nested call, the
    analyzer would resolve the inner calls again at every level.
    """
    call = "txt"
    for rule_id, step in lookup_steps("lex"):
        _create(spark, f"{name}_{rule_id}", step(call), params="txt STRING, lex ARRAY<STRING>")
        call = f"{name}_{rule_id}(txt, lex)"
    return call


def register_redact_table(spark: SparkSession, lexicon: NameLexicon, table: str, column: str, name: str = "redact_table") -> None:
    """``name()``: a table function that returns the rows of ``table`` with one more column, ``redacted``.

    The scalar function's subquery joins a large dictionary for each call in a query.  Here it is joined once for the
    whole table: the distinct words of each distinct text against the dictionary, and the look-up
    tables back to the rows.  Rows that a query leaves out by the table's own columns aren't redacted.
    A dictionary shared as a value is read in the expression.
    """
    fields = spark.table(table).schema.fields
    own = ", ".join(f"`{f.name}`" for f in fields)
    returns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["redacted STRING"])
    _create(spark, f"{name}_start", before_lookup(redact_patterns_sql("txt", FULL)))
    steps = after_lookup(_create_steps(spark, name))
    _create(spark, f"{name}_names", steps, params="txt STRING, lex ARRAY<STRING>")
    started = f"SELECT {own}, {name}_start(`{column}`) AS veil_txt FROM {table}"
    if lexicon.variable:
        body = f"SELECT {own}, {name}_names(veil_txt, {needed_words('veil_txt', lexicon.variable)}) FROM ({started})"
    else:
        lexicon.flags.createOrReplaceTempView(f"{name}_words")
        pairs = f"SELECT DISTINCT xxhash64(veil_txt) AS j, explode({lexicon.words_to_join('veil_txt')}) AS w FROM started"
        body = f"""
            WITH started AS ({started}),
            needed AS (SELECT j, {row_table(_HITS)} AS lex FROM ({pairs}) JOIN {name}_words ON word = w GROUP BY j)
            SELECT {own}, {name}_names(veil_txt, coalesce(lex, array('{EDGE}'))) FROM started LEFT JOIN needed ON xxhash64(veil_txt) = j"""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE ({returns}) RETURN {body}")

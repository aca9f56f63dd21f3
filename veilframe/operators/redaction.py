"""Redaction with the ordered regex rules, as one native Spark expression."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.rules import CORE, FEATURES, FULL, RARE, Rule, java_pattern, select_rules
from veilframe.functions.sqltext import evaluated_once, literal, quoted
from veilframe.operators.lexicon import NameLexicon
from veilframe.operators.names import after_lookup, before_lookup, lookup_steps


# Row classes, tried in order, as (features the text has, features it lacks).  Each
# pass of a rule decodes, copies and encodes the whole text, so a pass that cannot
# match is worth leaving out.  A text of no class meets no rule.  The features are
# those of the original text.
ROW_CLASSES: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...] = (
    (("digit", "rare"), ()),
    (("digit",), ("rare",)),
    (("mark",), ("digit",)),
    (("rare",), ("digit", "mark")),
)


def _rules_without(rules: list[Rule], lacking: tuple[str, ...]) -> list[Rule]:
    return [rule for rule in rules if not set(rule.needs) & set(lacking)]


def redact_patterns(text: Column, profile: str = FULL, families: Iterable[str] | None = None) -> Column:
    """Run the rules of a profile over ``text``; every rule reads the last result once."""
    rules = select_rules(profile, families)

    def has(feature: str) -> Column:
        if feature == "rare":
            return reduce(lambda a, b: a | b, [F.contains(text, F.lit(part)) for part in RARE])
        return F.rlike(text, F.lit(FEATURES[feature]))

    def chain(lacking: tuple[str, ...]) -> Column:
        return reduce(
            lambda col, rule: F.regexp_replace(col, F.lit(java_pattern(rule)), F.lit(rule.replacement)),
            _rules_without(rules, lacking),
            text,
        )

    cases = [(reduce(lambda a, b: a & b, map(has, present)), chain(lacking)) for present, lacking in ROW_CLASSES]
    return reduce(lambda col, case: col.when(*case), cases[1:], F.when(*cases[0])).otherwise(text)


def redact_core(text: Column) -> Column:
    """The reduced profile: 40 rules, no names."""
    return redact_patterns(text, CORE)


def redact_patterns_sql(text: str, profile: str = FULL) -> str:
    """The same expression as SQL text, for function bodies and ``selectExpr``."""
    rules = select_rules(profile)

    def has(feature: str) -> str:
        if feature == "rare":
            return "(" + " OR ".join(f"contains({text}, {literal(part)})" for part in RARE) + ")"
        return f"rlike({text}, {literal(FEATURES[feature])})"

    def chain(lacking: tuple[str, ...]) -> str:
        return reduce(
            lambda sql, rule: f"regexp_replace({sql}, {literal(java_pattern(rule))}, {literal(rule.replacement)})",
            _rules_without(rules, lacking),
            text,
        )

    cases = (f"WHEN {' AND '.join(map(has, present))} THEN {chain(lacking)}" for present, lacking in ROW_CLASSES)
    return f"CASE {' '.join(cases)} ELSE {text} END"


def redact(
    df: DataFrame, column: str, lexicon: NameLexicon | None = None, output: str = "redacted", profile: str = FULL
) -> DataFrame:
    """Add ``output``: the text of ``column`` after the pattern rules and, with a dictionary, the name rules."""
    patterns = redact_patterns(F.col(quoted(column)), profile)
    if lexicon is None:
        return evaluated_once(df, patterns, output)
    return redact_names(df.withColumn(output, patterns), output, lexicon, output)


def redact_names(df: DataFrame, column: str, lexicon: NameLexicon, output: str = "redacted") -> DataFrame:
    """Add ``output``: the text of ``column`` after the name and title rules alone."""
    table = f"__{output}_lexicon"
    result = df.withColumn(output, F.expr(before_lookup(quoted(column))))
    result = lexicon.attach(result, output, table)
    for _, step in lookup_steps(table):
        result = result.withColumn(output, F.expr(step(quoted(output))))
    return evaluated_once(result, F.expr(after_lookup(quoted(output))), output, kept=df.columns)

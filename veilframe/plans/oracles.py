"""Oracle SQL for rules on real text: the rule chain in the dialect of the oracle."""

from __future__ import annotations

from veilframe.functions.rules import CORE, HEX, RULES

# The plain form of the rules that are tuned for Java: groups put back, no
# possessive loops, no lookaround.
PLAIN = {
    "R1": (r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.\p{L}{2,}\b", "[EMAIL]"),
    "R17": (rf"(^|[^0-9A-Za-z:])::(?:{HEX}:){{0,6}}{HEX}\b", r"\1[IP]"),
    "R31": (r"(^|[^:0-9A-Za-z])(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?\b", r"\1[TIME]"),
    "R39": (
        r"\b\p{Lu}[\p{L}-]*(?:straße|strasse|str\.|-Straße|-Str\.|er Straße|er Str\.)(?: \d{1,4}(?: ?[a-z])?\b)?",
        "[ADDRESS]",
    ),
    "R40": (
        r"\b\p{Lu}[\p{L}-]*(?:weg|hof|gasse|platz|allee|ring|damm|ufer|chaussee|pfad|steig|stieg|promenade|kamp"
        r"|wall|graben|markt) \d{1,4}(?: ?[a-z])?\b",
        "[ADDRESS]",
    ),
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def chain(column: str, profile: str) -> str:
    """Every rule of the profile over ``column``, without row classes or lookaheads."""
    sql = column
    for rule in RULES:
        if profile in rule.profiles:
            greedy = rule.pattern.replace("*+", "*").replace("?+", "?")
            pattern, replacement = PLAIN.get(rule.rule_id, (greedy, rule.replacement.replace("$1", r"\1")))
            sql = f"regexp_replace({sql}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return sql


def chained(table: str, key: str, column: str, profile: str = CORE, where: str = "true") -> str:
    return f"SELECT {key}, {chain(column, profile)} AS redacted FROM {table} WHERE {where}"

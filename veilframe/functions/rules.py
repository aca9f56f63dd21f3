"""The ordered redaction rules, as data.

Each rule is one ``regexp_replace``.  Families run in the order below and rules
run top to bottom inside a family, each on the output of the one before, so the
order is part of the result.  ``operators.redaction`` folds the table into one
nested expression.

Patterns are in the Java dialect: every one is run with ``(?U)`` so that
``\\d \\w \\s \\b`` and case folding are Unicode-aware, "end of text" is ``\\z``,
and groups that are put back are numbered so the same replacement works from the
DataFrame API and from SQL text.

``needs`` names the features (``FEATURES``) a match cannot do without.  Replacement
tokens bring in none of them, so a text that lacks one at the start lacks it at every
step, and the rule can be left out for that row (see ``operators.redaction``).

``first`` names the characters a match can start with.  It becomes a lookahead in
front of the pattern: zero-width, so it changes no match, but the scan rejects
most positions on one cheap class test before it tries ``\\b`` or an alternation.
"""

from __future__ import annotations

from typing import NamedTuple

from veilframe.functions.regexes import exact_fold

CORE = "core"
FULL = "full"


class Rule(NamedTuple):
    rule_id: str
    family: str
    pattern: str
    replacement: str
    first: str = ""
    needs: tuple[str, ...] = ("digit",)
    profiles: tuple[str, ...] = (CORE, FULL)


# Building blocks of the IP patterns (fixed values): 0-255, IPv4, one IPv6 group.
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?:{OCTET}\.){{3}}{OCTET}"
HEX = r"[0-9A-Fa-f]{1,4}"

# What ``needs`` stands for.  Any decimal digit; a sign without which there is no
# e-mail address, IPv6 address or labelled value; and strings that are absent from most
# texts, looked for as they are, which costs next to nothing.
FEATURES: dict[str, str] = {"digit": r"\p{Nd}", "mark": r"[@:=>]"}
RARE: tuple[str, ...] = ("@", "::", "+", "(0", "Uhr", "straße", "strasse", "str.", "Straße", "Str.")

DIGIT = r"[\p{Nd}]"
CAPITAL = r"[A-Z]"
UPPER = r"[\p{Lu}]"
HEX_DIGIT = r"[0-9A-Fa-f]"

# The rule patterns and replacement tokens.
RULES: tuple[Rule, ...] = (
    # e-mail address.  The local part is possessive and starts where a run of its
    # characters starts (or where the last match ended), so a long unbroken run
    # without "@" is read once instead of once per character.
    Rule("R1", "EMAIL", r"(?:(?<![\w.+%-])|\G)[\w.+%-]++@(?=[\w-])(?:(?!\.\.)[\w.-])+\.\p{L}{2,}\b", "[EMAIL]", needs=("mark", "rare")),
    # driver's licence
    Rule("R2", "DRIVERLICENSE", r"\b[A-Z]\d[-. ]?\d{2}[-. ]?[A-Z0-9]{7}[-. ]?\d\b", "[DRIVERLICENSE]", CAPITAL),
    Rule(
        "R3",
        "DRIVERLICENSE",
        r"""(\b(?i:f(?:ü|\\u00fc)hrerschein(?:nummer|-?nr\.?|-nummer)?|fahrerlaubnis(?:nummer)?|fahrerlizenz|driver'?s?[_ ]?licen[cs]e(?:[_ ]?(?:number|no\.?|id))?|driverlicense)[ \t*"':=>]{1,6})(?:[A-Z][A-Z.\-]*\d[A-Z0-9.\-]*[A-Z0-9]|\d[A-Z0-9.\-]{3,}[A-Z0-9])\b""",
        "$1[DRIVERLICENSE]",
        "[FfDd]",
    ),
    # ID card
    Rule(
        "R4",
        "IDCARD",
        r"\b(?:[A-Z]{2}\d{7}|[A-Z]\d{8}|[A-Z]{2}\d{5}[A-Z]{2}|[A-Z]{3}\d{6}[A-Z]|[A-Z]\d{13}|\d{8}[A-Z]|[A-Z]\d{7}[A-Z])\b",
        "[IDCARD]",
        r"[A-Z\p{Nd}]",
    ),
    Rule(
        "R5",
        "IDCARD",
        r"""(\b(?i:(?:personal)?ausweis(?:nummer|-?nr\.?|-nummer|karte|dokument)?|id[-_ ]?kart(?:e|en-?nummer)|id[-_ ]?card(?:[-_ ]?(?:number|no\.?|nr\.?))?|identity[-_ ]card(?:[-_ ]number)?)[ \t*"':=>]{1,6})(?:[A-Z][A-Z.\-]*\d[A-Z0-9.\-]*[A-Z0-9]|\d[A-Z0-9.\-]{3,}[A-Z0-9])\b""",
        "$1[IDCARD]",
        "[PpAaIi]",
    ),
    # tax number
    Rule("R6", "TAX_ID", r"\b\d{2,3}/\d{3,4}/\d{4,5}\b", "[TAX_ID]", DIGIT),
    Rule(
        "R7",
        "TAX_ID",
        r"""(\b(?i:Steuer-?(?:nummer|nr\.?)|St\.-?Nr\.?|Steuer-?(?:identifikationsnummer|ID)|Tax\s?ID|Taxpayer\s?ID)[\s:*"'>=]{0,6})[0-9][0-9A-Z/ ]{8,14}[0-9]\b""",
        "$1[TAX_ID]",
        "[Ss\u017fTt]",
    ),
    # social security number: German, Swiss, French, US, name-based
    Rule(
        "R8",
        "SOCIALNUMBER",
        r"\b\d{2}[-. ]?\d{2}[-. ]?\d{2}[-. ]?\d{2}[-. ]?[A-Z]\d{2}[-. ]?\d\b",
        "[SOCIALNUMBER]",
        DIGIT,
    ),
    Rule("R9", "SOCIALNUMBER", r"\b756[-. ]?\d{4}[-. ]?\d{4}[-. ]?\d{2}\b", "[SOCIALNUMBER]", "7"),
    Rule(
        "R10",
        "SOCIALNUMBER",
        r"\b[12][-. ]?\d{2}[-. ]?\d{2}[-. ]?\d{5}[-. ]?\d{3}[-. ]?\d{2}\b",
        "[SOCIALNUMBER]",
        "[12]",
    ),
    Rule(
        "R11",
        "SOCIALNUMBER",
        r"\b\d{3}-\d{2}-\d{4}\b|\b\d{3}\.\d{2}\.\d{4}\b|\b\d{3} \d{2} \d{4}\b",
        "[SOCIALNUMBER]",
        DIGIT,
    ),
    Rule(
        "R12",
        "SOCIALNUMBER",
        r"\b[A-Z][a-z]{2}[-. ]?[A-Z][a-z]{2}[-. ]?\d{2}[-. ]?[A-Z][-. ]?\d{2}[-. ]?\d[-. ]?[A-Z]{3}\b",
        "[SOCIALNUMBER]",
        CAPITAL,
    ),
    # IP address: IPv4-mapped, IPv4, full IPv6, "::" inside or at the end, "::" first
    Rule("R13", "IP", rf"(?i:::ffff:){IPV4}\b", "[IP]", ":", ("digit", "rare")),
    Rule("R14", "IP", rf"\b{IPV4}([^.0-9A-Za-z]|\.(?:[^0-9A-Za-z]|\z)|\z)", "[IP]$1", DIGIT),
    Rule("R15", "IP", rf"\b(?:{HEX}:){{3,7}}{HEX}\b", "[IP]", HEX_DIGIT, ("mark",)),
    Rule("R16", "IP", rf"\b(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}}\b|\b(?:{HEX}:){{1,7}}:", "[IP]", HEX_DIGIT, ("mark", "rare")),
    # R17 and R31: the character before is tested, not taken.  A match ends in a
    # digit or hex digit, after which another one cannot start, so testing gives the
    # same result as taking the character and putting it back.
    Rule("R17", "IP", rf"(?<![0-9A-Za-z:])::(?:{HEX}:){{0,6}}{HEX}\b", "[IP]", ":", ("mark", "rare")),
    # IBAN: compact, grouped
    Rule("R18", "IBAN", r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", "[IBAN]", CAPITAL),
    Rule("R19", "IBAN", r"\b[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?\b", "[IBAN]", CAPITAL),
    # date
    Rule(
        "R20",
        "DATE",
        r"\b\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?",
        "[DATE]",
        DIGIT,
    ),
    Rule("R21", "DATE", r"\b\d{1,2}/\d{1,2}/\d{4}\b", "[DATE]", DIGIT),
    Rule("R22", "DATE", r"\b\d{1,2}\.\d{1,2}\.\d{4}\b", "[DATE]", DIGIT),
    Rule("R23", "DATE", r"\b\d{4}-\d{1,2}-\d{1,2}\b", "[DATE]", DIGIT),
    Rule("R24", "DATE", r"\b\d{1,2}\.\d{1,2}\.\d{2}\b", "[DATE]", DIGIT),
    Rule("R25", "DATE", r"\b\d{1,2}-\d{1,2}-\d{4}\b", "[DATE]", DIGIT),
    Rule("R26", "DATE", r"\b\d{4}/\d{1,2}/\d{1,2}\b", "[DATE]", DIGIT),
    Rule(
        "R27",
        "DATE",
        r"\b\d{1,2}\.\s?(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\s\d{4}\b",
        "[DATE]",
        DIGIT,
    ),
    Rule(
        "R28",
        "DATE",
        r"\b\d{1,2}\.\s?(?:Jan|Feb|Mär|Apr|Mai|Jun|Jul|Aug|Sep|Okt|Nov|Dez)\.?\s\d{4}\b",
        "[DATE]",
        DIGIT,
    ),
    Rule(
        "R29",
        "DATE",
        r"\b(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\s\d{4}\b",
        "[DATE]",
        "[JFMASOND]",
    ),
    Rule("R30", "DATE", r"\b\d{1,2}\.\d{1,2}\.\B", "[DATE]", DIGIT, profiles=(FULL,)),
    # time: the "Uhr" of a German time is kept
    Rule(
        "R31",
        "TIME",
        r"(?<![:0-9A-Za-z])(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?\b",
        "[TIME]",
        DIGIT,
    ),
    Rule("R32", "TIME", r"\b(?:[01]?\d|2[0-4])\.[0-5]\d(\s?Uhr)\b", "[TIME]$1", DIGIT, ("digit", "rare")),
    Rule("R33", "TIME", r"\b(?:[01]?\d|2[0-4])(\s?Uhr)\b", "[TIME]$1", DIGIT, ("digit", "rare")),
    Rule("R34", "TIME", r"\b(?:[01]?\d|2[0-4])h\b", "[TIME]", DIGIT),
    # phone: international, national, area code in parentheses
    Rule(
        "R35",
        "PHONE",
        r"\+\d{1,3}[-. /]?(?:\(0\)[-. /]?)?\d{1,5}(?:[-. /]?\d{2,9}){1,4}\b",
        "[PHONE]",
        needs=("digit", "rare"),
    ),
    Rule("R36", "PHONE", r"\b0\d{2,9}[-. /]\d{3,9}(?:[-. /]\d{2,9}){0,3}\b", "[PHONE]", "0"),
    Rule("R37", "PHONE", r"\(0\d{2,5}\)[-. /]?\d{3,9}(?:[-. /]?\d{2,9}){0,3}\b", "[PHONE]", needs=("digit", "rare")),
    # postal address (blanks after the separator are possessive: the value starts with
    # the first other character in any case): labelled value, street, street with number, postcode and city
    Rule(
        "R38",
        "ADDRESS",
        r"""(\b(?i:straße|strasse|street|gebäude|building(?:_number)?|hausnummer|postleitzahl|plz|post_?code|postal[_ ]?code|stadt|city|ort|bundesland|state|zweite adresse|zweitadresse|sekundäre adresse|zusätzliche adresse|nebenadresse|zusatzadresse|secondary[_ ]?address|sec_?address)[ \t*"']*[:=>][ \t*"']*+(?:</?[a-z]+>[ \t]*+)?+)[^"'<>\n*,]*[^"'<>\n*,\s]""",
        "$1[ADDRESS]",
        "[Ss\u017fGgBbHhPpCcOoZzNn]",
        ("mark",),
    ),
    # In a chain of hyphenated parts only the first capitalised one is tried: the later
    # ones reach no suffix it does not reach.  (After "er Straße" a match ends inside a
    # word, so parts behind "Str..." are tried too.)
    Rule(
        "R39",
        "ADDRESS",
        r"\b(?:(?<!-)|(?<!\b(?!Str)\p{Lu}\p{L}{0,40}-))\p{Lu}[\p{L}-]*(?:straße|strasse|str\.|-Straße|-Str\.|er Straße|er Str\.)(?: \d{1,4}(?: ?[a-z])?\b)?",
        "[ADDRESS]",
        UPPER,
        ("rare",),
    ),
    Rule(
        "R40",
        "ADDRESS",
        # the suffix ends where the run of letters ends, so the run is read once
        r"\b(?:(?<!-)|(?<!\b\p{Lu}\p{L}{0,40}-))\p{Lu}[\p{L}-]*+(?= \d)(?<=weg|hof|gasse|platz|allee|ring|damm|ufer|chaussee|pfad|steig|stieg|promenade|kamp|wall|graben|markt) \d{1,4}(?: ?[a-z])?\b",
        "[ADDRESS]",
        UPPER,
    ),
    Rule(
        "R41",
        "ADDRESS",
        r"\[ADDRESS\],? (?:D-)?\d{5} \p{Lu}[\p{L}-]+(?: (?:im|am|an der|ob der|vor der) \p{Lu}[\p{L}-]+| ?\(\p{Lu}\p{L}+\)|/\p{Lu}\p{L}+)?",
        "[ADDRESS]",
    ),
)

FAMILIES: tuple[str, ...] = tuple(dict.fromkeys(rule.family for rule in RULES))


def select_rules(profile: str = FULL, families: tuple[str, ...] | None = None) -> list[Rule]:
    """Rules of a profile, in order; ``families`` narrows the list."""
    if profile not in (CORE, FULL):
        raise ValueError(f"unknown profile: {profile}")
    unknown = set(families or ()) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown families: {sorted(unknown)}")
    return [r for r in RULES if profile in r.profiles and (families is None or r.family in families)]


def java_pattern(rule: Rule) -> str:
    ahead = f"(?={rule.first})" if rule.first else ""
    # R11 and R16 are alternations at top level, hence the group
    body = exact_fold(rule.pattern)
    return f"(?U){ahead}(?:{body})" if ahead else f"(?U){body}"

"""Names and titles: dictionary-backed rules as native Spark expressions.

The replacement depends on dictionary look-ups and on the position of a word in
its sequence, which ``regexp_replace`` alone cannot say.  Each rule is therefore

1. **mark**: one ``regexp_replace`` puts marks around what the rule's pattern
   offers (``EDGE lead MID sequence EDGE``), leaving the rest as it is;
2. **split** at the edges, so that every second element is an offered sequence;
3. **code**: every word of a sequence becomes one letter telling what the
   dictionary knows about it (``CODES`` below), so "Anna von Schmidt" is "GpS".
   All conditions of the rules are then short regexes over that code;
4. **label**: the words the code regex takes become numbered tokens;
5. **join** the elements again.

A rule reads the text of the one before exactly once, so the chain stays linear,
runs in the JVM and shuffles nothing.  The part of the dictionary a row needs is a
column (see ``operators.lexicon``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from veilframe.functions import name_patterns as P
from veilframe.functions.regexes import exact_fold
from veilframe.functions.sqltext import bind, literal
from veilframe.operators.lookup import EDGE, ESCAPE, FLAG_DIGITS, MID, flag, flag_number

_ESCAPED = {ESCAPE: ESCAPE + "\ufdd5", EDGE: ESCAPE + "\ufdd3", MID: ESCAPE + "\ufdd4"}

# One letter per word.  The index is the flag sum of the dictionary: 1 given name,
# 2 surname, 4 ambiguous, 8 stop word.  Capitals are unambiguous names:
# g/G given only, s/S surname only, b/B both, x not listed, - stop word, p particle.
CODES = "xGSBxgsb--------"
NAME = "[gsbGSB]"
UNAMBIGUOUS = "[GSB]"

# How many words are taken from the start of a sequence, by what the first must be.
ANY_FIRST = f"^[^-](?:p*{NAME})*"
LISTED_FIRST = f"^{NAME}(?:p*{NAME})*"
UNAMBIGUOUS_FIRST = f"^{UNAMBIGUOUS}(?:p*{NAME})*"
# A given name and at least one more name; at most one such run fits in four words.
RUN = f"[gbGB](?:p*{NAME})+"

# How many names, particles left out, are given names: the first one and those
# after it that are given names only.  A single name follows the dictionary, and
# where that is silent the default of the rule.
GIVEN_BY_DEFAULT = "^(?![sS]$).[gG]*"
LAST_BY_DEFAULT = "^(?![^gG]$).[gG]*"


class NameRule(NamedTuple):
    """``pattern`` captures lead and sequence as the groups in ``lead`` and ``words``.

    The other fields are SQL over the values bound while a sequence is labelled:
    ``lead``, ``seq``, ``code`` and, for ``given``, ``names`` (the code without
    particles).
    """

    rule_id: str
    pattern: str
    first: str = ""  # the characters a match starts with, place by place; s and k also as U+017F and U+212A
    lead: str = "$1"
    words: str = "$2"
    skipped: str = "''"  # code of the words before the taken ones
    taken: str = "code"  # code of the words taken; empty: leave the sequence alone
    given: str = f"length(regexp_extract(names, {literal(GIVEN_BY_DEFAULT)}, 0))"
    start: str = "1"
    out_lead: str = "lead"
    value_end: bool = False  # the value has to end after the sequence
    or_titles: bool = False  # a sequence of titles becomes titles
    needs: tuple[str, ...] = ()  # a match holds one of these; a text without any is left alone
    names_only: bool = False  # only an unambiguous name is ever replaced; a text without any is left alone

    @property
    def keeps_lead(self) -> bool:
        """Whether the lead stays and decides nothing; it is then left out of what is offered."""
        read = (self.taken, self.given, self.start, self.out_lead if self.out_lead != "lead" else "")
        return not self.value_end and not any("lead" in sql for sql in read)


def _prefix(code_regex: str) -> str:
    return f"regexp_extract(code, {literal(code_regex)}, 0)"


def _any_unambiguous(code: str) -> str:
    return f"rlike({code}, {literal(UNAMBIGUOUS)})"


def _labelled(label: str) -> str:
    return rf"(\b(?i:{label}){P.LABEL_NUMBER}{P.SEPARATOR})({P.name_sequence(3)})"


_TITLES_ONLY = literal(rf"(?U)^{P.TITLE}(?: {P.TITLE})*\z")
_CORE_TITLE_INSIDE = literal(rf"(?U)(?:^| ){P.CORE_TITLE} ")
_AS_TITLES = "regexp_replace({}, '[^ ]+', '[TITLE]')"

# The first digit of a label, or what it says in words.
_LABEL_START = (
    "CASE WHEN rlike(lead, '[0-9]') THEN cast(regexp_extract(lead, '[0-9]', 0) AS INT) "
    "WHEN rlike(lower(lead), 'zweit|second|middle') THEN 2 "
    "WHEN rlike(lower(lead), 'dritt|third') THEN 3 ELSE 1 END"
)
# "My first name is" and "my last name is" settle the kind.
_PHRASE_GIVEN = (
    "CASE WHEN rlike(lower(lead), 'vorname|first') THEN length(names) "
    "WHEN rlike(lower(lead), 'nachname|last') THEN 0 "
    f"ELSE length(regexp_extract(names, {literal(GIVEN_BY_DEFAULT)}, 0)) END"
)

_TITLE_FIELD = rf"(\b(?i:{P.TITLE_LABEL}){P.SEPARATOR})({P.TITLE_VALUE})"

NAME_RULES: tuple[NameRule, ...] = (
    # One or more titles and a name.  When no name follows the last title, that
    # title is itself offered as the name.
    NameRule(
        "N2",
        rf"\b(?={P.TITLE} )(?:((?:{P.TITLE} )++)({P.name_sequence(2)})"
        rf"|((?:{P.TITLE} (?={P.TITLE} ))++)({P.name_sequence(2)}))",
        first="[ABDEFGHIKMOPRSVÄ]",
        lead="$1$3",
        words="$2$4",
        taken=f"if(rlike(lead, {_CORE_TITLE_INSIDE}), {_prefix(ANY_FIRST)}, {_prefix(LISTED_FIRST)})",
        given=f"length(regexp_extract(names, {literal(LAST_BY_DEFAULT)}, 0))",
        out_lead=_AS_TITLES.format("lead"),
    ),
    # Labelled given, last and full names.
    NameRule(
        "N3",
        _labelled(P.GIVEN_LABEL),
        first="[ZzDdVvRrFfGgSs\u017fMm][WwRrOoUuIiEe][EeIiRrFfVvCcDd]",
        given="length(names)",
        start=_LABEL_START,
        needs=P.SEPARATORS,
    ),
    NameRule(
        "N4",
        _labelled(P.LAST_LABEL),
        first="[ZzDdNnFfGgSs\u017fLl][WwRrAaEeUu][EeIiCcMmBbRrSs\u017f]",
        given="0",
        start=_LABEL_START,
        needs=P.SEPARATORS,
    ),
    NameRule(
        "N5",
        _labelled(P.FULL_LABEL),
        first="[NnFfVvPpTtMmKk\u212aAa][AaUuOoEeIiNn][MmLlTtIiNnSs\u017fRr]",
        taken=f"if({_any_unambiguous('code')}, code, '')",
        needs=P.SEPARATORS,
        names_only=True,
    ),
    # Phrases, greetings and signatures.
    NameRule(
        "N6",
        rf"({P.NAME_PHRASE})({P.name_sequence(3)})",
        first="[MmIi][EeCcYy][IiHh ]",
        taken=_prefix(ANY_FIRST),
        given=_PHRASE_GIVEN,
    ),
    NameRule(
        "N7",
        rf"({P.AUTHOR_PHRASE})({P.name_sequence(3)})",
        first="[AaBbCcEeFfGgHhKk\u212aNnPpSs\u017fUuVvWwZz][OoRrEeAaNnIiPp][MmTtIiEeCcRrFfLlSs\u017fNnPpGg]",
        taken=_prefix(UNAMBIGUOUS_FIRST),
        needs=(" von ", " by "),
        names_only=True,
    ),
    NameRule(
        "N8",
        rf"({P.GREETING})({P.name_sequence(3)})",
        first="[LHDSMG][iaeou][elyarhit ,]",
        taken=_prefix(UNAMBIGUOUS_FIRST),
        names_only=True,
    ),
    NameRule(
        "N9",
        rf"({P.SIGNATURE})({P.name_sequence(3)})",
        first="[BbCcFfgHhKk\u212aLlMmRrSs\u017fVv][IiRrEeCcHh][TtEeSs\u017fRrHhNnGgZz]",
        taken=_prefix(UNAMBIGUOUS_FIRST),
        needs=("\n", "\\n", "gez."),
        names_only=True,
    ),
    # A value that stands alone and is made up of names only.
    NameRule(
        "N10",
        rf"({P.VALUE_START})({P.name_sequence(3)})",
        taken=(
            f"if(rlike(code, '^(?:p|{NAME})+$') AND {_any_unambiguous('code')} "
            "AND (length(replace(code, 'p', '')) > 1 OR char_length(seq) >= 3), code, '')"
        ),
        value_end=True,
        or_titles=True,
    ),
    # A run of capitalised words holding a given name followed by another name.  A
    # lone word can never be one, so the pattern asks for a second word.  Later parts of
    # a hyphenated word are no starts: the first part has been tried and ends the same.
    NameRule(
        "N11",
        rf"\b(?:(?<!-)|(?<!{P.PART_BEFORE}))()({P.name_sequence(3, at_least=1)})",
        first=r"\p{Lu}",
        skipped=f"regexp_extract(code, {literal(f'^(.*?){RUN}')}, 1)",
        taken=(
            f"if({_any_unambiguous(f'regexp_extract(code, {literal(RUN)}, 0)')}, "
            f"regexp_extract(code, {literal(RUN)}, 0), '')"
        ),
        names_only=True,
    ),
)


def _code(table: str) -> str:
    """The code of ``words``.  A hyphenated word also counts as listed where all of
    its parts are, and as ambiguous where any part is."""
    parts = f"transform(split(w, '-'), t -> {flag_number(flag(table, 't'))})"
    whole = flag_number(flag(table, "w"))
    combined = f"{whole} | aggregate(f, 3, (a, v) -> a & v) | (aggregate(f, 0, (a, v) -> a | v) & 4)"
    hyphenated = bind(parts, "f", f"substr('{CODES}', ({combined}) + 1, 1)")
    particles = ", ".join(literal(p) for p in P.PARTICLE_WORDS)
    letter = (
        f"CASE WHEN w IN ({particles}) THEN 'p' WHEN instr(w, '-') = 0 "
        f"THEN translate({flag(table, 'w')}, '{FLAG_DIGITS}{EDGE}', '{CODES}x') ELSE {hyphenated} END"
    )
    return f"array_join(transform(words, w -> {letter}), '')"


def _tokens(rule: NameRule) -> str:
    """The taken words as numbered tokens; particles stay."""
    ordinal = "length(replace(substr(taken, 1, k + 1), 'p', ''))"
    token = bind(
        ordinal,
        "o",
        "if(o <= given, '[GIVENNAME' || (o + first - 1) || ']', '[LASTNAME' || (o - given + first - 1) || ']')",
    )
    one = f"if(substr(taken, k + 1, 1) = 'p', w, {token})"
    labelled = f"array_join(transform(slice(words, skip + 1, length(taken)), (w, k) -> {one}), ' ')"
    before = "if(skip > 0, array_join(slice(words, 1, skip), ' ') || ' ', '')"
    after = (
        "if(skip + length(taken) < size(words), "
        "' ' || array_join(slice(words, skip + length(taken) + 1, size(words)), ' '), '')"
    )
    out_lead = "" if rule.keeps_lead else f"{rule.out_lead} || "
    labelled = f"{out_lead}{before} || {labelled} || {after}"
    labelled = bind(rule.start, "first", labelled)
    labelled = bind(rule.given, "given", bind(f"length({rule.skipped})", "skip", labelled))
    return bind("replace(taken, 'p', '')", "names", labelled)


def _rewrite(rule: NameRule, table: str) -> str:
    """The new text of one offered part."""
    same = "seq" if rule.keeps_lead else "lead || seq"
    labelled = bind(rule.taken, "taken", f"if(taken = '', {same}, {_tokens(rule)})")
    labelled = bind("split(seq, ' ')", "words", bind(_code(table), "code", labelled))
    if rule.or_titles:
        labelled = f"if(rlike(seq, {_TITLES_ONLY}), lead || {_AS_TITLES.format('seq')}, {labelled})"
    return labelled


def _marked(text: str, pattern: str, first: str, template: str) -> str:
    ahead = f"(?={first})" if first else ""
    return f"regexp_replace({text}, {literal(f'(?Umd){ahead}(?:{exact_fold(pattern)})')}, {literal(template)})"


def _apply(marked: str, rewrite: str, lead: bool = True) -> str:
    """Split at the edges, rewrite what lies between them, join again."""
    body = bind(f"split(x, '{MID}')", "y", bind("y[0]", "lead", bind("y[1]", "seq", rewrite))) if lead else rewrite
    part = "x" if lead else "seq"
    joined = f"array_join(transform(split(m, '{EDGE}'), ({part}, i) -> if(i % 2 = 0, {part}, {body})), '')"
    return bind(marked, "m", f"if(contains(m, '{EDGE}'), {joined}, m)")


def _where_needed(text: str, needs: tuple[str, ...], rewrite: Callable[[str], str], listed: str = "") -> str:
    """``rewrite`` for texts that hold one of ``needs`` and meet ``listed``; each pass it leaves out is a copy of the
    text saved."""
    held = " OR ".join(f"contains(src, {literal(part)})" for part in needs)
    conditions = " AND ".join(f"({condition})" for condition in (held, listed) if condition)
    return bind(text, "src", f"if({conditions}, {rewrite('src')}, src)") if conditions else rewrite(text)


def _holds_name(table: str) -> str:
    """Whether the look-up table holds a word that makes a letter of ``UNAMBIGUOUS``, alone or as a part of a hyphenated
    word, where being a stop word doesn't count."""
    digits = "".join(d for k, d in enumerate(FLAG_DIGITS) if k & 3 and not k & 4)
    return f"exists({table}, b -> rlike(b, '{MID}[{digits}]'))"


def _rule_sql(text: str, rule: NameRule, table: str) -> str:
    listed = _holds_name(table) if rule.names_only else ""
    return _where_needed(text, rule.needs, lambda source: _rewritten(source, rule, table), listed)


def _rewritten(text: str, rule: NameRule, table: str) -> str:
    if rule.keeps_lead:
        marked = _marked(text, rule.pattern, rule.first, f"{rule.lead}{EDGE}{rule.words}{EDGE}")
        return _apply(marked, _rewrite(rule, table), lead=False)
    marked = _marked(text, rule.pattern, rule.first, f"{EDGE}{rule.lead}{MID}{rule.words}{EDGE}")
    if rule.value_end:
        # Tested after the match is made, so that a failed test cannot shorten the
        # name.  An edge in between belongs to the next value; only the edge that
        # opens a value has a MID before the next edge.
        end = rf"(?![ \t]*{EDGE}?{P.VALUE_END})|(?=[ \t]*{EDGE}?{P.KEY_END})"
        refused = rf"{EDGE}([^{EDGE}{MID}]*){MID}([^{EDGE}]*){EDGE}(?:{end})"
        marked = f"regexp_replace({marked}, {literal(refused)}, '$1$2')"
    return _apply(marked, _rewrite(rule, table))


def _title_field_sql(text: str) -> str:
    """N1: the words after "Titel:".  Lower-case ``title>`` is mostly the title of a
    web page, so there only known titles are replaced."""
    page = f"startswith(lead, 'title>') AND NOT rlike(seq, {_TITLES_ONLY})"
    rewrite = f"if({page}, lead || seq, lead || {_AS_TITLES.format('seq')})"

    def titled(source: str) -> str:
        return _apply(_marked(source, _TITLE_FIELD, "[TtAaSs\u017f]", f"{EDGE}$1{MID}$2{EDGE}"), rewrite)

    return _where_needed(text, P.SEPARATORS, titled)


def before_lookup(text: str) -> str:
    """Escape the marks and run the one rule without look-ups."""
    return _title_field_sql(reduce(lambda sql, p: f"replace({sql}, '{p[0]}', '{p[1]}')", _ESCAPED.items(), text))


def lookup_steps(table: str) -> list[tuple[str, Callable[[str], str]]]:
    """The rules with look-ups, in order, as (rule, text to rewritten text) in SQL.

    One step per projection: nested in one another they would need more analyzer
    rounds than Spark allows.  The optimizer merges them into one projection again.
    """
    return [(rule.rule_id, lambda text, rule=rule: _rule_sql(text, rule, table)) for rule in NAME_RULES]


def after_lookup(text: str) -> str:
    """Undo the escapes."""
    return reduce(lambda sql, p: f"replace({sql}, '{p[1]}', '{p[0]}')", reversed(_ESCAPED.items()), text)

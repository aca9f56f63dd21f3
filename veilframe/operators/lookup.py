"""Word look-ups as plain SQL over an array of buckets.

A bucket is one string, ``EDGE word MID flag`` for each of its words, so that a
look-up is a hash, an array access and a substring search: no lambda, no join.
The flag is one hexadecimal digit, the sum of 1 given name, 2 surname, 4 ambiguous
and 8 stop word.
"""

from __future__ import annotations

from veilframe.functions import name_patterns as P
from veilframe.functions.sqltext import bind, literal

# Marks are Unicode noncharacters; texts that hold them are escaped first.
EDGE, MID, ESCAPE = "\ufdd0", "\ufdd1", "\ufdd2"
FLAG_DIGITS = "0123456789abcdef"

# A row's own table: about so many words per bucket, and no more buckets than this.
ROW_WORDS, ROW_BUCKETS = 8, 64


def flag(table: str, word: str) -> str:
    """The flag digit of a word, EDGE when it is not listed."""
    bucket = f"get({table}, cast(pmod(xxhash64({word}), size({table})) AS INT))"
    return f"substr(substring_index({bucket}, '{EDGE}' || {word} || '{MID}', -1), 1, 1)"


def flag_number(digit: str) -> str:
    return f"instr('{FLAG_DIGITS[1:]}', {digit})"


def entry(word: str, digit: str) -> str:
    return f"'{EDGE}' || {word} || '{MID}' || {digit}"


def candidate_words(text: str) -> str:
    """The distinct words of a text the name rules may look up, and the parts of hyphenated ones."""
    words = f"regexp_extract_all({text}, {literal(f'(?U)({P.WORD})')}, 1)"
    parts = "flatten(transform(filter(c, w -> instr(w, '-') > 0), w -> split(w, '-')))"
    return bind(words, "c", f"array_union(c, {parts})")


def row_table(hits: str) -> str:
    """The array of buckets for ``hits``, an array of ``struct<h: hash of the word, e: entry>``."""
    own = "array_join(transform(filter(hits, x -> pmod(x.h, n) = b), x -> x.e), '')"
    buckets = f"transform(sequence(0, n - 1), b -> coalesce(nullif({own}, ''), '{EDGE}'))"
    return bind(hits, "hits", bind(f"least({ROW_BUCKETS}, 1 + size(hits) div {ROW_WORDS})", "n", buckets))


def needed_words(text: str, table: str) -> str:
    """The part of ``table`` that ``text`` needs.  Reads ``table`` in one place only: it
    may be a value of many megabytes, which Spark compares and hashes wherever it occurs."""
    looked_up = f"struct(xxhash64(w) AS h, {entry('w', flag('d', 'w'))} AS e)"
    all_words = bind(table, "d", f"transform({candidate_words(text)}, w -> {looked_up})")
    return row_table(f"filter({all_words}, x -> NOT endswith(x.e, '{EDGE}'))")


# A Bloom filter over the words of a dictionary: an array of 64-bit numbers, and so many bits for each word.
FILTER_HASHES = 3


def filter_places(word: str, n_bits: int) -> list[str]:
    """The places of a word's bits in a filter of ``n_bits``."""
    return [f"pmod(xxhash64({word}, {k}), {n_bits}L)" for k in range(FILTER_HASHES)]


def perhaps_listed(words: str, table: str, n_bits: int) -> str:
    """Those of ``words`` that the filter ``table`` may hold; none that it holds is lost.  Reads ``table`` in one place."""
    tests = [f"getbit(get(d, cast({place} div 64 AS INT)), cast({place} % 64 AS INT)) = 1" for place in filter_places("w", n_bits)]
    return bind(table, "d", f"filter({words}, w -> {' AND '.join(tests)})")

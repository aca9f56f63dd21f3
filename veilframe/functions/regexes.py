"""Adjusting pattern text to the Java engine."""

from __future__ import annotations


def exact_fold(pattern: str) -> str:
    """Spell out the letter i inside ``(?i:...)`` groups.

    Java also folds the Turkish letters U+0130 and U+0131 to "i"; simple Unicode
    case folding does not, so inside these groups "i" becomes ``(?-i:[iI])``.
    """
    if "(?i:" not in pattern:
        return pattern
    out, depth, folded, k = [], 0, 0, 0
    while k < len(pattern):
        if pattern.startswith("(?i:", k):
            depth += 1
            folded = folded or depth
            out.append("(?i:")
            k += 4
            continue
        char = pattern[k]
        if char == "\\":
            out.append(pattern[k : k + 2])
            k += 2
            continue
        if char == "(":
            depth += 1
            if pattern.startswith("(?", k):
                out.append("(?")
                k += 2
                continue
        elif char == ")":
            if depth == folded:
                folded = 0
            depth -= 1
        out.append("(?-i:[iI])" if folded and char in "iI" else char)
        k += 1
    return "".join(out)

"""The name rules by brute force over one text, straight from their definitions.

Only the fixed patterns are shared with the engine.  Which words are taken and how
they are numbered is found by trying all possibilities.
"""

import regex

from veilframe.functions import name_patterns as P

GIVEN, SURNAME, AMBIGUOUS, STOP = 1, 2, 4, 8


class Brute:
    def __init__(self, flags):
        self.flags = flags

    def has(self, word, bit):
        if bit in (GIVEN, SURNAME):
            if self.flags.get(word, 0) & STOP:
                return False
            parts = word.split("-")
            whole = self.flags.get(word, 0) & bit
            return bool(whole or (len(parts) > 1 and all(self.flags.get(p, 0) & bit for p in parts)))
        return any(self.flags.get(p, 0) & bit for p in [word, *word.split("-")])

    def name(self, word):
        return self.has(word, GIVEN) or self.has(word, SURNAME)

    def sure(self, word):
        return self.name(word) and not self.has(word, AMBIGUOUS)

    def stop(self, word):
        return bool(self.flags.get(word, 0) & STOP)

    @staticmethod
    def particle(word):
        return not word[0].isupper()

    def longest(self, words):
        """The longest start of a sequence whose words after the first are names or
        particles, and which does not end in a particle."""
        for n in range(len(words), 0, -1):
            rest = words[1:n]
            if not self.particle(words[n - 1]) and all(self.particle(w) or self.name(w) for w in rest):
                return n
        return 0

    def number(self, words, kind, start=1, single="given"):
        names = [w for w in words if not self.particle(w)]
        only_given = [self.has(w, GIVEN) and not self.has(w, SURNAME) for w in names]
        only_last = [self.has(w, SURNAME) and not self.has(w, GIVEN) for w in names]
        if kind == "given":
            given = len(names)
        elif kind == "last":
            given = 0
        elif len(names) == 1:
            given = int(only_given[0] or (single == "given" and not only_last[0]))
        else:
            given = max(n for n in range(1, len(names) + 1) if all(only_given[1:n]))
        tokens = [f"[GIVENNAME{start + n}]" for n in range(given)]
        tokens += [f"[LASTNAME{start + n}]" for n in range(len(names) - given)]
        return " ".join(w if self.particle(w) else tokens.pop(0) for w in words)

    def prefix(self, sequence, first_ok, **labels):
        words = sequence.split(" ")
        n = self.longest(words) if first_ok(words[0]) else 0
        return " ".join(filter(None, [self.number(words[:n], **labels) if n else "", *words[n:]])) if n else None

    def redact(self, text):
        title = regex.compile(P.TITLE)

        def all_titles(value):
            return all(title.fullmatch(w) for w in value.split(" "))

        def sub(pattern, change):
            nonlocal text
            whole = text
            text = regex.sub(pattern, lambda m: change(m, whole[m.end() :]) or m[0], text, flags=regex.M)

        def titles(value):
            return " ".join("[TITLE]" for _ in value.split(" "))

        sub(
            rf"(\b(?i:{P.TITLE_LABEL}){P.SEPARATOR})({P.TITLE_VALUE})",
            lambda m, _: None if m[1].startswith("title>") and not all_titles(m[2]) else m[1] + titles(m[2]),
        )

        def after_titles(m, _):
            core = any(regex.fullmatch(P.CORE_TITLE, t) for t in m[1].split())
            done = self.prefix(
                m[2], lambda w: not self.stop(w) and (core or self.name(w)), kind="full", single="last"
            )
            return done and "[TITLE] " * len(m[1].split()) + done

        sub(rf"\b((?:{P.TITLE} )+)({P.name_sequence(2)})", after_titles)

        def start(label):
            digit = regex.search("[0-9]", label)
            words = {"zweit": 2, "second": 2, "middle": 2, "dritt": 3, "third": 3}
            return int(digit[0]) if digit else next((n for w, n in words.items() if w in label.lower()), 1)

        def field(label, change):
            sub(rf"(\b(?i:{label}){P.LABEL_NUMBER}{P.SEPARATOR})({P.name_sequence(3)})", change)

        field(P.GIVEN_LABEL, lambda m, _: m[1] + self.number(m[2].split(" "), "given", start(m[1])))
        field(P.LAST_LABEL, lambda m, _: m[1] + self.number(m[2].split(" "), "last", start(m[1])))
        field(
            P.FULL_LABEL,
            lambda m, _: m[1] + self.number(m[2].split(" "), "full") if any(map(self.sure, m[2].split(" "))) else None,
        )

        def phrase(m, _):
            said = m[1].lower()
            kind = "given" if "vorname" in said or "first" in said else "full"
            kind = "last" if "nachname" in said or "last" in said else kind
            done = self.prefix(m[2], lambda w: not self.stop(w), kind=kind)
            return done and m[1] + done

        sub(rf"({P.NAME_PHRASE})({P.name_sequence(3)})", phrase)
        for before in (P.AUTHOR_PHRASE, P.GREETING, P.SIGNATURE):

            def context(m, _):
                done = self.prefix(m[2], self.sure, kind="full")
                return done and m[1] + done

            sub(rf"({before})({P.name_sequence(3)})", context)

        end, key = P.VALUE_END.replace(r"\z", r"\Z"), P.KEY_END

        def value(m, rest):
            words = m[2].split(" ")
            if not regex.match(rf"[ \t]*{end}", rest) or regex.match(rf"[ \t]*{key}", rest):
                return None
            if all_titles(m[2]):
                return m[1] + titles(m[2])
            names = [w for w in words if not self.particle(w)]
            if all(map(self.name, names)) and any(map(self.sure, names)) and len(names[0]) + 9 * len(names) >= 12:
                return m[1] + self.number(words, "full")
            return None

        sub(rf"({P.VALUE_START})({P.name_sequence(3)})", value)

        def run(m, _):
            words = m[0].split(" ")
            for i in range(len(words)):
                n = self.longest(words[i:])
                names = [w for w in words[i : i + n] if not self.particle(w)]
                if self.has(words[i], GIVEN) and len(names) > 1 and any(map(self.sure, names)):
                    return " ".join([*words[:i], self.number(words[i : i + n], "full"), *words[i + n :]])
            return None

        sub(rf"\b{P.name_sequence(3)}", run)
        return text

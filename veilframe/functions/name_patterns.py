"""Fixed values of the name rules: word grammar, titles, labels and phrases.

Java dialect, run with ``(?U)``.  Loops that never need to give a part back are
possessive, so long runs ("la la la ...") neither backtrack nor deepen the stack.
"""

from __future__ import annotations

# A capitalised word, possibly hyphenated or with an apostrophe.
WORD = r"\p{Lu}[\p{Ll}'’]++(?:-\p{Lu}[\p{Ll}'’]++)*+"

# What stands before a later part of a hyphenated word (of usual length).
PART_BEFORE = r"\b\p{Lu}[\p{Ll}'’]{1,40}-"

# Particles between name words; "der" and "den" only after von/van.
PARTICLE = (
    r"(?:von der|von den|van der|van den|de la|von|van|de|del|della|di|da|du|la|le|ten|ter|zu|al|el|bin|ibn)"
)
PARTICLE_WORDS = (
    "von", "der", "den", "van", "de", "la", "del", "della", "di", "da", "du",
    "le", "ten", "ter", "zu", "al", "el", "bin", "ibn",
)

# After one of these, every capitalised word counts as a name.
CORE_TITLE = (
    r"(?:Herrn|Herr|Frau|Fräulein|Frl\.?|Dr\.|Prof\.|Doktorin|Doktor|Mrs\.?|Mr\.?|Ms\.?|Miss|Mx\.?|Sir|Dame"
    r"|Madame|Monsieur|Mme\.?|Mlle\.?)"
)
# These are also ordinary words, so the word that follows has to be in the dictionary.
EXTENDED_TITLE = (
    r"(?:Gräfin|Graf|Grf\.?|Baronin|Baron|Bar\.?|Freiherr|Freifrau|Fürstin|Fürst|Prinzessin|Prinz|Prz\.?"
    r"|Herzogin|Herzog|Hrz\.?|Erzherzogin|Erzherzog|Ehz\.?|Königin|König|Kön\.?|Kaiserin|Kaiser|Erbprinzessin"
    r"|Erbprinz|Erbin|Erb\.?|Pfarrerin|Pfarrer|Pastorin|Pastor|Pater|Bruder|Br\.?|Schwester|Schw\.?|Mutter|Vater"
    r"|Äbtissin|Abt|Prälat|Papst|Kardinal|Bischof|Reverend|Rev\.?|Rabbi|Imam|Stadträtin|Stadtrat|Bürgermeisterin"
    r"|Bürgermeister|Ministerin|Minister|Senatorin|Senator|Kommandeur|Kapitän|General|Oberst|Major|Rechtsanwältin"
    r"|Rechtsanwalt|Anwältin|Anwalt|Rätin|Rat)"
)
TITLE = rf"(?:{CORE_TITLE}|{EXTENDED_TITLE})"

# Between a label and its value.
SEPARATOR = r"""[ \t*"']*[:=>][ \t*"']*"""
SEPARATORS = (":", "=", ">")  # one of them is part of it
LABEL_NUMBER = r"(?:[ _]?[1-9])?"


def name_sequence(more: int, at_least: int = 0) -> str:
    """A name word and up to ``more`` further ones, with particles in between."""
    return rf"{WORD}(?: (?:{PARTICLE} )*+{WORD}){{{at_least},{more}}}"


# Labels in front of a value (case is ignored).
TITLE_LABEL = r"titel|title|anrede|salutation"
GIVEN_LABEL = (
    r"(?:zweiter |dritter )?vorname[n]?|rufname|first[_ ]?name|given[_ ]?name|givename|second[_ ]?name|middle[_ ]?name"
)
LAST_LABEL = r"(?:zweiter |dritter )?nachname|familienname|geburtsname|surname|last[_ ]?name|family[_ ]?name"
FULL_LABEL = (
    r"name|full[_ ]?name|vollständiger name|patient(?:in)?|teilnehmer(?:in)?|mitarbeiter(?:in)?|kunde|kundin"
    r"|ansprechpartner(?:in)?|kontaktperson|verantwortliche[r]?"
)
TITLE_VALUE = r"\p{Lu}[\p{L}-]*\.?(?: \p{Lu}[\p{L}-]*\.?){0,2}"

# Phrases in front of a name.
NAME_PHRASE = (
    r"\b(?i:mein name ist|mein vorname ist|mein nachname ist|ich heiße|ich heisse|my name is|my first name is"
    r"|my last name is) "
)
AUTHOR_PHRASE = (
    r"\b(?:(?i:kommentar|artikel|beitrag|feedback|nachricht|bericht|brief|anfrage|antrag|foto|bild|zitat"
    r"|unterstützung|hilfe) von|(?i:geschrieben|erstellt|verfasst|unterzeichnet|unterschrieben|gesendet|genehmigt"
    r"|geprüft) von|(?i:written|created|posted|sent|signed|approved) by) "
)
GREETING = r"\b(?:Liebe|Lieber|Liebes|Hallo|Hi|Hey|Dear|Servus|Moin|Sehr geehrte[rs]?(?:/r)?|Guten Tag|Guten Morgen)[ ,]+"
SIGNATURE = (
    r"(?:(?i:mit freundlichen grüßen|freundliche grüße|viele grüße|beste grüße|liebe grüße|herzliche grüße"
    r"|schöne grüße|best regards|kind regards|regards|sincerely|cheers)[,.!]?[ \t]*(?:(?:\r?\n|\\n)[ \t]*)++"
    r"|gez\.[ \t]+)"
)

# A value that stands alone: what comes before it, what has to come after it, and
# the end of a dictionary key, which is not a value.  Blanks may come before both ends.
VALUE_START = r"""(?:^[ \t]*+(?:[-*•]|\d+\.)?+|["'>|;,\[{(]|\\"|\*\*)[ \t]*+"""
VALUE_END = r"""(?:["'<|;,\]})\r\n*]|\\"|\\n|\z)"""
KEY_END = r"""(?:["']|\\")[ \t]*:"""

"""Sentences built from order keys, with the text each must become.

``k`` is ``o_orderkey`` and ``c`` is ``o_custkey``.  Both members of a case are SQL
that Spark and the oracle read alike.  The expected text is written out by hand, so
it does not depend on any pattern.  A family also holds rows that must stay.
"""

from __future__ import annotations


def _pad(expr: str, width: int) -> str:
    return f"lpad(cast({expr} AS string), {width}, '0')"


def _str(expr: str) -> str:
    return f"cast({expr} AS string)"


DAY, DAY2 = _str("k % 28 + 1"), _pad("k % 28 + 1", 2)
MONTH, MONTH2 = _str("k % 12 + 1"), _pad("k % 12 + 1", 2)
YEAR = _str("1950 + k % 60")
DIGIT = _str("k % 10")
SECOND2 = _pad("k % 60", 2)

# family -> cases of (text, expected); every pattern rule of the full profile is run
FAMILIES: dict[str, list[tuple[str, str]]] = {
    "EMAIL": [
        (f"'Mail an user' || {_str('k')} || '@mail' || {DIGIT} || '.example.com bitte'", "'Mail an [EMAIL] bitte'"),
        (f"{DAY2} || '.05.1990@gmail.com'", "'[EMAIL]'"),
        (f"'dünhaupt' || {_str('k')} || '@aol.com, a.b-c@x-y.de.'", "'[EMAIL], [EMAIL].'"),
        (f"'wert' || {_str('k')} || ' @ home'", f"'wert' || {_str('k')} || ' @ home'"),
        (f"'u' || {_str('k')} || '@a..de'", f"'u' || {_str('k')} || '@a..de'"),
    ],
    "DRIVERLICENSE": [
        (f"'Führerschein: M' || {_pad('k', 8)}", "'Führerschein: [DRIVERLICENSE]'"),
        (f"'T5-46-HLFZFTF-' || {DIGIT}", "'[DRIVERLICENSE]'"),
        (f"""'"driver_license": "' || {_pad('k', 10)} || '"'""", """'"driver_license": "[DRIVERLICENSE]"'"""),
        (f"'FÜHRERSCHEIN: K' || {_pad('k', 6)}", "'FÜHRERSCHEIN: [DRIVERLICENSE]'"),
        (f"'Fahrerlaubnis seit ' || {DIGIT}", f"'Fahrerlaubnis seit ' || {DIGIT}"),
    ],
    "IDCARD": [
        (f"'M' || {_pad('k', 8)}", "'[IDCARD]'"),
        (f"'RD' || {_pad('k', 7)} || ' und ' || {_pad('c', 8)} || 'A'", "'[IDCARD] und [IDCARD]'"),
        (f"'Ausweisnummer: W' || {_pad('k', 7)}", "'Ausweisnummer: [IDCARD]'"),
        (f"""'"id_card": "' || {_pad('k', 10)} || '"'""", """'"id_card": "[IDCARD]"'"""),
        (f"'W' || {_pad('k', 7)}", f"'W' || {_pad('k', 7)}"),
        (f"'RD' || {_pad('k', 5)} || 'XY und QRS' || {_pad('c', 6)} || 'T'", "'[IDCARD] und [IDCARD]'"),
        (f"'P' || {_pad('k', 13)} || ', V' || {_pad('c', 7)} || 'W'", "'[IDCARD], [IDCARD]'"),
    ],
    "TAX_ID": [
        (f"'Steuernummer: ' || {_pad('k', 11)}", "'Steuernummer: [TAX_ID]'"),
        (f"{_pad('k % 100', 2)} || '/' || {_pad('c % 1000', 3)} || '/' || {_pad('k', 5)}", "'[TAX_ID]'"),
        (f"'<TaxpayerID>733' || {_pad('k', 10)}", "'<TaxpayerID>[TAX_ID]'"),
        (f"'St.-Nr. 12 345 ' || {_pad('k % 1000', 3)} || ' 901'", "'St.-Nr. [TAX_ID]'"),
        (f"'Steuer 12 ' || {DIGIT}", f"'Steuer 12 ' || {DIGIT}"),
    ],
    "SOCIALNUMBER": [
        (f"'41-27-05-46-K77-' || {DIGIT}", "'[SOCIALNUMBER]'"),
        (f"'756.' || {_pad('k % 10000', 4)} || '.' || {_pad('c % 10000', 4)} || '.37'", "'[SOCIALNUMBER]'"),
        (f"'2.64.04.' || {_pad('k', 5)} || '.005.13'", "'[SOCIALNUMBER]'"),
        (f"{_pad('k % 1000', 3)} || '-09-2502'", "'[SOCIALNUMBER]'"),
        (f"'CarFol25C41' || {DIGIT} || 'AIP'", "'[SOCIALNUMBER]'"),
        (f"'SV 72.16.10.63.B04.' || {DIGIT}", "'SV [SOCIALNUMBER]'"),
        (f"'669-09 ' || {_pad('k % 10000', 4)}", f"'669-09 ' || {_pad('k % 10000', 4)}"),
    ],
    "IP": [
        (f"'Server 10.' || {_str('k % 256')} || '.' || {_str('c % 256')} || '.7 up'", "'Server [IP] up'"),
        (f"'7:57 fe80::1:' || {_str('k % 1000')} || ' ::1'", "'[TIME] [IP] [IP]'"),
        (f"'IP 1.2.3.4.' || {_str('k % 256')}", "'IP 1.[IP]'"),
        (f"'ends 10.1.2.' || {_str('k % 256')} || chr(10)", "'ends [IP]' || chr(10)"),
        (f"'::ffff:192.168.1.' || {_str('k % 256')}", "'[IP]'"),
        (f"'a893:d59e:e7ef:4ec3:520d:1710:207:' || {DIGIT}", "'[IP]'"),
        (f"'std::abc' || {_str('k')}", f"'std::abc' || {_str('k')}"),
    ],
    "IBAN": [
        (f"'DE89 3704 0044 0532 ' || {_pad('k % 10000', 4)} || ' 00'", "'[IBAN]'"),
        (f"'Konto DE8937040044' || {_pad('k', 10)}", "'Konto [IBAN]'"),
        (f"'de89370400440532' || {_pad('k', 6)}", f"'de89370400440532' || {_pad('k', 6)}"),
    ],
    "DATE": [
        (f"'2064-01-05T10:00:0' || {DIGIT} || 'Z'", "'[DATE]'"),
        (f"{DAY2} || '/' || {MONTH2} || '/' || {YEAR}", "'[DATE]'"),
        (f"{DAY} || '.' || {MONTH} || '.' || {YEAR}", "'[DATE]'"),
        (f"{YEAR} || '-' || {MONTH} || '-' || {DAY}", "'[DATE]'"),
        (f"{DAY2} || '.' || {MONTH2} || '.' || {_pad('k % 100', 2)}", "'[DATE]'"),
        (f"{DAY2} || '-' || {MONTH2} || '-' || {YEAR}", "'[DATE]'"),
        (f"{YEAR} || '/' || {MONTH} || '/' || {DAY}", "'[DATE]'"),
        (f"{DAY} || '. Januar ' || {YEAR}", "'[DATE]'"),
        (f"{DAY} || '. Jan. ' || {YEAR}", "'[DATE]'"),
        (f"'im März ' || {YEAR}", "'im [DATE]'"),
        (f"'am ' || {DAY2} || '.01. und 10.00 Uhr, 9-17 Uhr'", "'am [DATE] und [TIME] Uhr, 9-[TIME] Uhr'"),
        (f"'Version 1.' || {DIGIT}", f"'Version 1.' || {DIGIT}"),
    ],
    "TIME": [
        (f"'um ' || {_str('k % 24')} || ':' || {SECOND2} || ' da'", "'um [TIME] da'"),
        (f"'12:36:' || {SECOND2} || ',7:57'", "'[TIME],[TIME]'"),
        (f"{_str('k % 24')} || '.' || {SECOND2} || ' Uhr'", "'[TIME] Uhr'"),
        (f"'um ' || {_str('k % 25')} || ' Uhr'", "'um [TIME] Uhr'"),
        (f"{_str('k % 25')} || 'h'", "'[TIME]'"),
        (f"'um 29:' || {SECOND2}", f"'um 29:' || {SECOND2}"),
    ],
    "PHONE": [
        (f"'+49 30 ' || {_pad('k', 7)}", "'[PHONE]'"),
        (f"'+49 (0)30 ' || {_pad('k', 7)}", "'[PHONE]'"),
        (f"'Tel. 030 ' || {_pad('c', 7)} || ' bitte'", "'Tel. [PHONE] bitte'"),
        (f"'(030) ' || {_pad('k', 7)}", "'[PHONE]'"),
        (f"'074' || {_pad('k', 7)}", f"'074' || {_pad('k', 7)}"),
    ],
    "ADDRESS": [
        (f"'Straße: Klappenweg ' || {DIGIT}", "'Straße: [ADDRESS]'"),
        (f"'Hauptstraße ' || {_str('k % 100 + 1')} || ', 10115 Berlin'", "'[ADDRESS]'"),
        (f"'Ort: Köln Tel 030 ' || {_pad('k', 7)} || ' x'", "'Ort: [ADDRESS]'"),
        (f"'state: done' || {_str('k')}", "'state: [ADDRESS]'"),
        (f"'Am Lindenplatz ' || {_str('k % 99 + 1')}", "'Am [ADDRESS]'"),
        (f"'<city>Ort' || {_str('k')} || '</city>'", "'<city>[ADDRESS]</city>'"),
        (f"'Ringstr. ' || {DIGIT} || ' D-79117 Freiburg im Breisgau'", "'[ADDRESS]'"),
        (f"'Heimweg ohne ' || {DIGIT}", f"'Heimweg ohne ' || {DIGIT}"),
    ],
}

# A name word made from a customer key, and what the dictionary says about it:
# 0 given, 1 surname, 2 both, 3 surname and ambiguous, 4 given and stop word.
WORD = "'Ke' || translate(lpad(cast(c AS string), 9, '0'), '0123456789', 'abdefgiklm')"
NAME_WORDS = f"""
    SELECT {WORD} AS word, c % 5 IN (0, 2, 4) AS is_given, c % 5 IN (1, 2, 3) AS is_surname,
           c % 5 = 3 AS is_ambiguous, c % 5 = 4 AS is_stop
    FROM (SELECT DISTINCT o_custkey AS c FROM orders) t
"""


def _by_role(*expected: str) -> str:
    """SQL for the expected text by role; ``{w}`` in a text stands for the word itself."""
    texts = (f" || {WORD} || ".join(f"'{part}'" for part in text.split("{w}")) for text in expected)
    arms = " ".join(f"WHEN {role} THEN {text}" for role, text in enumerate(texts))
    return f"CASE c % 5 {arms} END"


def _one(before: str, after: str, *expected: str) -> tuple[str, str]:
    return f"'{before}' || {WORD} || '{after}'", _by_role(*expected)


NAMES: dict[str, list[tuple[str, str]]] = {
    "name_title_field": [
        ("'Titel: Dr., Nr. ' || cast(k AS string)", "'Titel: [TITLE], Nr. ' || cast(k AS string)"),
        ("'Anrede: Herr Graf|' || cast(k AS string)", "'Anrede: [TITLE] [TITLE]|' || cast(k AS string)"),
        ("'<title>Seite</title>' || cast(k AS string)", "'<title>Seite</title>' || cast(k AS string)"),
        ("'<title>Frau</title>' || cast(k AS string)", "'<title>[TITLE]</title>' || cast(k AS string)"),
    ],
    "name_title_context": [
        _one(
            "als Herr ", " kam",
            "als [TITLE] [GIVENNAME1] kam", "als [TITLE] [LASTNAME1] kam", "als [TITLE] [LASTNAME1] kam",
            "als [TITLE] [LASTNAME1] kam", "als Herr {w} kam",
        ),
        _one(
            "als Graf ", " kam",
            "als [TITLE] [GIVENNAME1] kam", "als [TITLE] [LASTNAME1] kam", "als [TITLE] [LASTNAME1] kam",
            "als [TITLE] [LASTNAME1] kam", "als Graf {w} kam",
        ),
        _one(
            "zu Frau Dr. Zyx von ", " ging",
            "zu [TITLE] [TITLE] [GIVENNAME1] von [GIVENNAME2] ging",
            "zu [TITLE] [TITLE] [GIVENNAME1] von [LASTNAME1] ging",
            "zu [TITLE] [TITLE] [GIVENNAME1] von [LASTNAME1] ging",
            "zu [TITLE] [TITLE] [GIVENNAME1] von [LASTNAME1] ging",
            "zu [TITLE] [TITLE] [LASTNAME1] von {w} ging",
        ),
        ("'der Bruder Zyx Nr ' || cast(k AS string)", "'der Bruder Zyx Nr ' || cast(k AS string)"),
    ],
    "name_fields": [
        _one("Vorname: ", "", *["Vorname: [GIVENNAME1]"] * 5),
        _one("Zweiter Vorname: ", ".", *["Zweiter Vorname: [GIVENNAME2]."] * 5),
        _one("Nachname: Zyx ", ".", *["Nachname: [LASTNAME1] [LASTNAME2]."] * 5),
        _one('"last_name3": "', '"', *['"last_name3": "[LASTNAME3]"'] * 5),
        _one(
            "Kunde: ", " .",
            "Kunde: [GIVENNAME1] .", "Kunde: [LASTNAME1] .", "Kunde: [GIVENNAME1] .", "Kunde: {w} .", "Kunde: {w} .",
        ),
        _one("second_name: ", ".", *["second_name: [GIVENNAME2]."] * 5),
        _one("Dritter Nachname = ", ";", *["Dritter Nachname = [LASTNAME3];"] * 5),
    ],
    "name_phrases": [
        _one(
            "Mein Name ist ", " und",
            "Mein Name ist [GIVENNAME1] und", "Mein Name ist [LASTNAME1] und", "Mein Name ist [GIVENNAME1] und",
            "Mein Name ist [LASTNAME1] und", "Mein Name ist {w} und",
        ),
        _one(
            "my last name is ", " ok", *["my last name is [LASTNAME1] ok"] * 4, "my last name is {w} ok",
        ),
        _one(
            "ein Kommentar von ", " dazu",
            "ein Kommentar von [GIVENNAME1] dazu", "ein Kommentar von [LASTNAME1] dazu",
            "ein Kommentar von [GIVENNAME1] dazu", "ein Kommentar von {w} dazu", "ein Kommentar von {w} dazu",
        ),
        _one(
            "Hallo ", " dort",
            "Hallo [GIVENNAME1] dort", "Hallo [LASTNAME1] dort", "Hallo [GIVENNAME1] dort", "Hallo {w} dort",
            "Hallo {w} dort",
        ),
        _one(
            "x gez. ", " dort",
            "x gez. [GIVENNAME1] dort", "x gez. [LASTNAME1] dort", "x gez. [GIVENNAME1] dort", "x gez. {w} dort",
            "x gez. {w} dort",
        ),
        *[
            _one(
                before, after,
                f"{before}[GIVENNAME1]{after}", f"{before}[LASTNAME1]{after}", f"{before}[GIVENNAME1]{after}",
                before + "{w}" + after, before + "{w}" + after,
            )
            for before, after in (
                ("bis bald\nBeste Grüße,\n\n", "\nweiter"),
                ("so kind regards\n", " dort"),
                ("it was written by ", " then"),
                ("er wurde erstellt von ", " dort"),
                ("Dear ", " dort"),
                ("Guten Tag, ", " dort"),
                ("Sehr geehrter ", " dort"),
            )
        ],
    ],
    "name_delimited": [
        _one(
            '{"a": ["', '"]}',
            '{"a": ["[GIVENNAME1]"]}', '{"a": ["[LASTNAME1]"]}', '{"a": ["[GIVENNAME1]"]}', '{"a": ["{w}"]}',
            '{"a": ["{w}"]}',
        ),
        _one('{"', '": 1}', *['{"{w}": 1}'] * 5),
        _one("<b>", " x</b>", *["<b>{w} x</b>"] * 5),
        _one(
            "1,", ",Vater,x",
            "1,[GIVENNAME1],[TITLE],x", "1,[LASTNAME1],[TITLE],x", "1,[GIVENNAME1],[TITLE],x", "1,{w},[TITLE],x",
            "1,{w},[TITLE],x",
        ),
    ],
    "name_runs": [
        (
            f"'wie ' || {WORD} || ' von ' || {WORD} || ' sagte'",
            _by_role(
                "wie [GIVENNAME1] von [GIVENNAME2] sagte", "wie {w} von {w} sagte",
                "wie [GIVENNAME1] von [LASTNAME1] sagte", "wie {w} von {w} sagte", "wie {w} von {w} sagte",
            ),
        ),
        (
            f"'wie Zyx ' || {WORD} || ' ' || {WORD} || '-' || {WORD} || ' Zyx sagte'",
            _by_role(
                "wie Zyx [GIVENNAME1] [GIVENNAME2] Zyx sagte", "wie Zyx {w} {w}-{w} Zyx sagte",
                "wie Zyx [GIVENNAME1] [LASTNAME1] Zyx sagte", "wie Zyx {w} {w}-{w} Zyx sagte",
                # a stop word inside a hyphenated word does not count as one
                "wie Zyx {w} {w}-{w} Zyx sagte",
            ),
        ),
        _one("dann ging ", " weiter", *["dann ging {w} weiter"] * 5),
    ],
}


def case_sql(cases: list[tuple[str, str]], member: int) -> str:
    """The text (member 0) or the expected text (member 1) of an order."""
    arms = " ".join(f"WHEN {n} THEN {case[member]}" for n, case in enumerate(cases))
    return f"CASE k % {len(cases)} {arms} END"


def texts_sql(cases: list[tuple[str, str]], member: int, name: str) -> str:
    return (
        f"SELECT k AS o_orderkey, {case_sql(cases, member)} AS {name} "
        "FROM (SELECT o_orderkey AS k, o_custkey AS c FROM orders) t"
    )

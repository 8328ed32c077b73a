"""Characters that look alike, and text folding for comparisons.

The tables of width, font, ligature, blank and composition forms come by rule from
the Unicode database; only the look-alike letters of other scripts, which that
database does not hold, are written out.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import regex

# Letters of other scripts and their Latin look-alikes.
LOOKALIKE = {
    "ipa": dict(zip("ɑɡɩ", "agi")),
    "greek": dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναιρυ", "ABEZHIKMNOPTYXovaipu")),
    "cyrillic": dict(zip("АВЕЅІЈКМНОРСТУХԚԜаесорхуѕіјԛԝһӏԁ", "ABESIJKMHOPCTYXQWaecopxysijqwhld")),
    "armenian": dict(zip("ՕՍԼօոսհցզ", "OULonuhgq")),
}
SCRIPTS = {"greek": "Greek", "cyrillic": "Cyrillic", "armenian": "Armenian"}

# Hyphens that look like the ordinary one.
HYPHENS = "‐‑⁃﹣－"
#: Format characters that other scripts need are dropped as well where they stand in Latin text.
INVISIBLE_CATEGORIES = ("Cf",)


@lru_cache(None)
def invisible() -> tuple[str, ...]:
    """Characters without any width: format characters, variation selectors and fillers."""
    found = [c for c in map(chr, range(0x80, 0xE1000)) if unicodedata.category(c) in INVISIBLE_CATEGORIES]
    # The marks of subtending numbers in Arabic, Syriac and Kaithi are format characters that are seen.
    seen = {c for c in found if regex.match(r"[\p{Arabic}\p{Syriac}\p{Kaithi}]", c) or 0x600 <= ord(c) <= 0x605}
    fillers = ["͏", "ᅟ", "ᅠ", "឴", "឵", "ㅤ", "ﾠ", *map(chr, range(0xFE00, 0xFE10))]
    return tuple(sorted({*found, *fillers} - seen))


@lru_cache(None)
def stand_ins() -> dict[str, tuple[str, str]]:
    """Character to (kind, ordinary text): the forms that are no ordinary ones wherever they stand.

    Kinds: ``invisible``, ``blank``, ``hyphen``, ``width``, ``font``, ``ligature``, and
    ``canonical`` for second code points of one and the same character (Kelvin and Angstrom
    signs, compatibility ideographs).
    """
    out = {c: ("invisible", "") for c in invisible()}
    for i in (*range(0x80, 0x20000), *range(0x2F800, 0x2FA20)):
        c = chr(i)
        how = unicodedata.decomposition(c)
        if unicodedata.category(c) == "Zs":
            out[c] = ("blank", " ")
        elif c in HYPHENS:
            out[c] = ("hyphen", "-")
        elif how.startswith(("<wide>", "<narrow>")):
            out[c] = ("width", unicodedata.normalize("NFKC", c))
        elif how.startswith("<font>"):
            out[c] = ("font", unicodedata.normalize("NFKC", c))
        elif how.startswith("<compat>") and 0xFB00 <= i <= 0xFB06:
            out[c] = ("ligature", unicodedata.normalize("NFKC", c))
        elif how and not how.startswith("<") and unicodedata.normalize("NFC", c) != c:
            out[c] = ("canonical", unicodedata.normalize("NFC", c))
    return out


@lru_cache(None)
def compositions() -> dict[str, str]:
    """Canonical decomposition to the precomposed character, for every character that composes."""
    out = {}
    for i in range(0xC0, 0x20000):
        c = chr(i)
        if 0xAC00 <= i <= 0xD7A3 or not unicodedata.decomposition(c) or unicodedata.decomposition(c).startswith("<"):
            continue
        if unicodedata.normalize("NFC", c) == c:
            out[unicodedata.normalize("NFD", c)] = c
    return out


@lru_cache(None)
def pairs() -> dict[str, str]:
    """Two characters to the one that they compose to; Hangul follows an arithmetic rule and is not listed."""
    out = {}
    for i in range(0xC0, 0x20000):
        c = chr(i)
        how = unicodedata.decomposition(c)
        if how and not how.startswith("<") and " " in how and not 0xAC00 <= i <= 0xD7A3 and unicodedata.normalize("NFC", c) == c:
            out["".join(chr(int(x, 16)) for x in how.split())] = c
    return out


#: Hangul: the first syllable, leading consonants, vowels and trailing consonants, and how many of each there are.
HANGUL = {"syllable": 0xAC00, "lead": 0x1100, "vowel": 0x1161, "trail": 0x11A7}
LEADS, VOWELS, TRAILS = 19, 21, 28


@lru_cache(None)
def joiners() -> tuple[str, ...]:
    """Characters without a combining class that may compose with the one before: second halves of vowels, jamo."""
    seconds = {p[1] for p in pairs() if not unicodedata.combining(p[1])}
    jamo = {chr(HANGUL["vowel"] + i) for i in range(VOWELS)} | {chr(HANGUL["trail"] + i) for i in range(1, TRAILS)}
    return tuple(sorted(seconds | jamo))


def letters() -> dict[str, tuple[str, str]]:
    """Look-alike letter to (script, Latin letter)."""
    return {c: (script, latin) for script, table in LOOKALIKE.items() for c, latin in table.items()}


@lru_cache(None)
def _translation() -> dict[int, str]:
    return {ord(c): to for c, (_, to) in stand_ins().items()}


@lru_cache(None)
def _letter_translation() -> dict[int, str]:
    return {ord(c): latin for c, (_, latin) in letters().items()}


_WORD = regex.compile(r"[\p{L}\p{M}]+")
_LATIN = regex.compile(r"\p{Latin}")
_GAP = regex.compile(r"[\W_]+")


@lru_cache(None)
def _suspect() -> re.Pattern:
    """Any character that may not stand in the plain form."""
    marks = (c for c in map(chr, range(0x300, 0x10000)) if unicodedata.category(c)[0] == "M")
    low = sorted({*(chr(i) for i in _translation() if i < 0x10000), *marks})
    return re.compile("[" + re.escape("".join(low)) + "]|[\U00010000-\U0010ffff]")


@lru_cache(None)
def _foreign() -> re.Pattern:
    return re.compile("[" + "".join(map(chr, _letter_translation())) + "]")


def plain(text: str) -> str:
    """``text`` with stand-ins made ordinary and look-alikes inside Latin words made Latin, composed."""
    if text.isascii():
        return text
    if _suspect().search(text):
        text = unicodedata.normalize("NFC", text.translate(_translation()))
    if _foreign().search(text):
        fix, latin = _letter_translation(), _LATIN.search(text) is not None
        text = _WORD.sub(lambda m: m[0].translate(fix) if _LATIN.search(m[0]) or (latin and len(m[0]) == 1 and m[0].upper() in "ΑА") else m[0], text)
    return text


#: Letters with a stroke or joined letters, which do not decompose. Fixed values.
STROKES = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ı": "i", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "Ø": "O", "Ł": "L", "Đ": "D", "Æ": "AE", "Œ": "OE"})


def fold(text: str | None) -> str:
    """Lower-case words of ``text`` without accents, punctuation and look-alikes, one blank between; '' for null."""
    if not text:
        return ""
    text = plain(text)
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text.translate(STROKES)) if not unicodedata.combining(c))
    return _GAP.sub(" ", text.casefold()).strip()

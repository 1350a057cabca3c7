"""P2 charset detection for bytes that are not UTF-8 and name no charset.

Two steps: byte patterns rule out encodings in which the bytes are not valid
(strict decoding), then each remaining reading is scored by how ordinary its
characters are for the languages of that encoding.  A reading scores the mean
over its non-ASCII characters: letters frequent in the language count most,
other letters of the script less, signs nothing, characters that no such text
holds against it; a capital inside a word counts against it too (which tells
the Cyrillic encodings apart, whose letter cases lie the other way round).
Ties go to the order of the table.
"""

from __future__ import annotations

import codecs
import re
import unicodedata

# ---------------------------------------------------------------------------
# Byte-order marks and frequent letters by language family.
# ---------------------------------------------------------------------------

BYTE_ORDER_MARKS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"),
                    (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]
CYRILLIC = "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъіїєґўјљњћђџ"
GREEK = "αοιετσνηυρπκμλςωγδβχθφξζψάέήίόύώϊϋΐΰ"
HEBREW = "יוהלאתרבשמנכחדעפקזגטסצםןךףץ"
ARABIC = "اليمونرتبةعدسفحكقجشطصخهذضزثغظءآأإئؤىپچژگک"
WESTERN = "éèàçùêâîôûëïüœäößñáíóúãõåøæ¿¡ìòðþý"
CENTRAL = "ąćęłńóśźżáčďéěíňřšťúůýžőöűüľĺôâăîșțşţđ"
TURKISH = "ıığşçöüâîû"
THAI = "านรอกเงมยลวดทสตะปบคหแจพชขใไโผซถ"
TYPOGRAPHY = "’‘“”„–—…«»°·§©®€"

# encoding, what its text is made of: a set of frequent letters, or the name of a scoring rule below
ENCODINGS = [("shift_jis", "japanese"), ("cp932", "japanese"), ("euc_jp", "japanese"), ("euc_kr", "korean"), ("cp949", "korean"),
             ("gb18030", "chinese"), ("big5", "chinese"), ("cp1252", WESTERN), ("cp1251", CYRILLIC), ("koi8_r", CYRILLIC),
             ("koi8_u", CYRILLIC), ("cp866", CYRILLIC), ("iso8859_5", CYRILLIC), ("cp1250", CENTRAL), ("iso8859_2", CENTRAL),
             ("cp1253", GREEK), ("cp1254", TURKISH), ("cp1255", HEBREW), ("cp1256", ARABIC), ("cp874", THAI)]
# ---------------------------------------------------------------------------

_ASCII = bytes(range(128))
_ISO_2022_JP = re.compile(rb"\x1b\$[@B]|\x1b\([BJ]")
_MIXED_CASE = re.compile(r"[^\W\d_]{2,}")


def _common_han(encoding: str) -> frozenset[str]:
    """Characters of an encoding's first level, the frequent ones by its own design."""
    rows = {"gb2312": range(0xB0, 0xD8), "big5": range(0xA4, 0xC7)}[encoding]
    trail = [*range(0x40, 0x7F), *range(0xA1, 0xFF)]
    text = "".join(bytes([a, b]).decode(encoding, "ignore") for a in rows for b in trail)
    return frozenset(c for c in text if "一" <= c <= "鿿")


_HAN = {"gb18030": _common_han("gb2312"), "big5": _common_han("big5")}


def _east_asian(c: str, kind: str, encoding: str) -> float:
    if "　" <= c <= "〿" or "！" <= c <= "～":
        return 0.6  # the script's own punctuation
    if kind == "japanese":
        if "ぁ" <= c <= "ヾ":
            return 1.0
        if "｡" <= c <= "ﾟ":
            return -0.5  # half-width katakana: rare, and what wrong bytes decode to
        return 0.45 if "一" <= c <= "鿿" else -1.0
    if kind == "korean":
        return 1.0 if "가" <= c <= "힣" else 0.1 if "一" <= c <= "鿿" else -1.0
    if c in _HAN[encoding]:
        return 0.9
    return 0.0 if "一" <= c <= "鿿" else -1.0


def _letters(c: str, frequent: str) -> float:
    low = c.lower()
    if low in frequent:
        points = 1.0 if frequent.index(low) * 2 < len(frequent) else 0.7
        return points if c == low else 0.6 * points  # running text is in small letters
    if c in TYPOGRAPHY or c == "\xa0":
        return 0.3
    kind = unicodedata.category(c)
    return -0.3 if kind[0] == "L" else -0.5 if kind[0] in "MPZ" else -1.0


def score(text: str, kind: str, encoding: str) -> float:
    """How ordinary a reading's non-ASCII characters are: at most 1."""
    counts: dict[str, int] = {}
    for c in text:
        if c > "\x7f":
            counts[c] = counts.get(c, 0) + 1
    total = sum(counts.values())
    if not total:
        return 0.0
    rule = _letters if kind not in ("japanese", "korean", "chinese") else lambda c, k: _east_asian(c, k, encoding)
    points = sum(n * rule(c, kind) for c, n in counts.items())
    if rule is _letters:
        odd = sum(sum(b.isupper() and a.islower() for a, b in zip(w, w[1:])) for w in _MIXED_CASE.findall(text) if not w.isascii())
        points -= 1.5 * odd
    return points / total


def detect(raw: bytes) -> str:
    """Name of the encoding that reads ``raw`` best; Latin-1 where none is at all ordinary."""
    for mark, name in BYTE_ORDER_MARKS:
        if raw.startswith(mark):
            return name
    if not raw.translate(None, _ASCII):
        return "iso2022_jp" if _ISO_2022_JP.search(raw) else "ascii"
    best, found = 0.0, "latin_1"
    for name, kind in ENCODINGS:
        try:
            text = raw.decode(name)
        except UnicodeDecodeError:
            continue
        got = score(text, kind, name)
        if got > best + 1e-9:
            best, found = got, name
    return found


def decode(raw: bytes, name: str | None = None) -> str:
    """Text of bytes in the charset named, or in the one detected when none (or no text codec) is named."""
    if name:
        try:
            return raw.decode(name, "replace")
        except (LookupError, UnicodeError):
            pass
    return raw.decode(detect(raw), "replace")

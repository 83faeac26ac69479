"""The likely charset of bytes that are no UTF-8, by how often their pairs occur in each candidate's languages.

Each candidate that decodes the bytes without an error is scored by its characters beyond ASCII. In double-byte charsets the first
byte of a pair tells whether it lies among the frequent characters, the kana or the rare ones. In single-byte charsets the pair
of neighbours counts: letters of one alphabet in lower case are likely, capitals behind small letters, letters of two alphabets
side by side, two accented Latin letters in a row and control characters are not. Ties go to the first candidate of ``CANDIDATES``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: First bytes of double-byte charsets and what a character among them counts; other pairs count RARE, single bytes beyond ASCII SINGLE.
ROWS = {
    "euc_kr": ((0xB0, 0xC8, 1.0),),
    "euc_jp": ((0xA4, 0xA5, 1.0), (0xA1, 0xA1, 0.6), (0xB0, 0xCF, 0.8), (0xD0, 0xF4, -0.2)),
    "shift_jis": ((0x82, 0x83, 1.0), (0x81, 0x81, 0.6), (0x88, 0x97, 0.8), (0x98, 0x9F, -0.2), (0xE0, 0xEA, -0.2)),
    "gb18030": ((0xA3, 0xA3, 0.6), (0xA1, 0xA1, 0.6), (0xB0, 0xD7, 0.9), (0xD8, 0xF7, 0.0)),
    "big5": ((0xA1, 0xA1, 0.6), (0xA4, 0xC6, 0.9), (0xC9, 0xF9, 0.0)),
}
CANDIDATES = ("cp1252", "cp1251", "koi8_r", *ROWS)
RARE, SINGLE = -0.5, -0.6
LAST = "latin_1"


def _lead_score(data: bytes, name: str, text: str) -> float:
    """Mean over the characters beyond ASCII, by their first bytes."""
    rows, total, n = ROWS[name], 0.0, 0
    for c in text:
        if c < "\x80":
            continue
        raw = c.encode(name)
        n += 1
        if len(raw) == 1:
            total += SINGLE
        elif name in ("gb18030", "euc_kr", "euc_jp") and raw[1] < 0xA1:
            total += RARE
        else:
            total += next((w for low, high, w in rows if low <= raw[0] <= high), RARE)
    return total / n if n else 0.0


def _alphabet(c: str) -> str:
    return "latin" if c.isalpha() and c < "\u0250" else "cyrillic" if "\u0400" <= c < "\u0530" else ""


def _pair_score(text: str) -> float:
    """Mean over the pairs of neighbours of which one is beyond ASCII."""
    total, n = 0.0, 0
    for a, b in zip(" " + text, text + " ", strict=True):
        if a < "\x80" and b < "\x80":
            continue
        n += 1
        x, y = _alphabet(a), _alphabet(b)
        if "\x80" <= min(a, b) < "\xa0" or "\x80" <= max(a, b) < "\xa0":
            total -= 2
        elif x and y:
            if x != y or a.islower() and b.isupper():
                total -= 1
            elif x == "latin" and a >= "\x80" and b >= "\x80":
                total -= 0.5
            else:
                total += 0.5 if a.isupper() and b.isupper() else 1
        elif (x or y) and (a if y else b) >= "\x80" and not (a if y else b).isspace():
            total -= 0.3  # a sign beyond ASCII beside a letter
        else:
            total += 0.6 if x or y else 0.2
    return total / n if n else 0.0


def charset(data: bytes) -> str:
    """The name of the likeliest charset; Latin-1 if no candidate decodes the bytes."""
    best, name = float("-inf"), LAST
    for candidate in CANDIDATES:
        cut = data
        while True:  # the limit may have cut the last pair
            try:
                text = cut.decode(candidate)
                break
            except UnicodeDecodeError as e:
                if e.start < len(data) - 3 or len(cut) < len(data) - 3:
                    text = None
                    break
                cut = cut[: e.start]
        if text is None:
            continue
        score = _lead_score(cut, candidate, text) if candidate in ROWS else _pair_score(text)
        if score > best + 1e-9:
            best, name = score, candidate
    return name


@F.pandas_udf(StringType())
def likely_text(content: pd.Series) -> pd.Series:
    """Text of each blob by its likely charset, null for null; what can't be decoded at its end becomes U+FFFD."""
    return pd.Series([None if c is None else bytes(c).decode(charset(bytes(c)), "replace") for c in content], dtype=object)

"""String expressions that Spark lacks, all inside whole-stage code generation."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What str.strip() takes off: Unicode white space and the four separators.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _ends_printed(c: Column) -> Column:
    """The last byte is a printed ASCII character, so no blank is at the end. Spark's trims on the right list every character of a text first."""
    return F.substring(c.cast("binary"), -1, 1).between(F.lit(bytearray(b"!")), F.lit(bytearray(b"~")))


def strip(c: Column) -> Column:
    return F.when(_ends_printed(c), F.ltrim(c, F.lit(BLANKS))).otherwise(F.btrim(c, F.lit(BLANKS)))


def rstrip(c: Column) -> Column:
    return F.when(_ends_printed(c), c).otherwise(F.rtrim(c, F.lit(BLANKS)))


def some_text(*parts: Column) -> Column:
    """Some part holds more than blanks. Of long texts the first part that does decides."""
    found = F.lit(False)
    for c in parts:
        found = found | (F.length(F.ltrim(c, F.lit(BLANKS))) > 0)
    return found


def byte_length(c: Column) -> Column:
    return F.octet_length(c)


def last_index(s: Column, sub: str) -> Column:
    """0-based place of the last occurrence, -1 without one."""
    at = F.instr(F.reverse(s), sub[::-1])
    return F.when(at > 0, F.length(s) - len(sub) - at + 1).otherwise(F.lit(-1))


def count_of(s: Column, sub: str) -> Column:
    """Non-overlapping occurrences."""
    return ((F.length(s) - F.length(F.replace(s, F.lit(sub)))) / F.lit(len(sub))).cast("int")


def prefix(c: Column, n: int) -> Column:
    """First n code points; '' for null."""
    return F.substring(F.coalesce(c, F.lit("")), 1, n)


def any_word(words: tuple[str, ...]) -> str:
    return r"\b(" + "|".join(words) + r")\b"


def literal_heads(pattern: str) -> list[str]:
    """Lower-case text that any match of a pattern, one group of alternatives, begins with; [] if some alternative has none."""
    group = re.fullmatch(r"(?:\\b|\^)?\(?(.*?)\)?(?:\\b)?", pattern, re.S)[1]
    heads = [re.match(r"[^\\\[\](){}.*+?^$|]*", part)[0].lower() for part in group.split("|")]
    return [] if any(len(h) < 2 for h in heads) else heads


def matches(c: Column, pattern: str, low: Column | None = None) -> Column:
    """c holds a match of `pattern`, ASCII case aside. Byte searches for its literal heads spare most texts the regex.

    `low` is c in lower case, if that is known already.
    """
    found = c.rlike("(?i)" + pattern)
    heads = literal_heads(pattern)
    if not heads:
        return found
    some, low = F.lit(False), F.lower(c) if low is None else low
    for h in dict.fromkeys(heads):
        some = some | low.contains(h)
    return some & found


def with_lower(c: Column, test: Callable[[Column, Column], Column]) -> Column:
    """test(c, c in lower case), both made once for a row, however often and wherever the test names them."""
    both = F.array(F.struct(c.alias("text"), F.lower(c).alias("low")))
    return F.get(F.transform(both, lambda t: test(t["text"], t["low"])), F.lit(0))


def cut_with_marker(c: Column, n: int, marker: str) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(marker))).otherwise(c)

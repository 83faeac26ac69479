"""Code around the lines that a diff changes: the one kernel that scans lines with state, run in Arrow batches."""

from __future__ import annotations

import re
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from .. import config

_HUNK = re.compile(r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@")
_STARTS = [re.compile(p) for p in config.FUNCTION_STARTS]
_CALL = re.compile(r".*\w+\s*\([^)]*\)")
BACK, AHEAD, SPAN = 100, 500, 100
AROUND_FUNCTION, AROUND_CHANGE, GAP = 3, 20, 5
SEPARATOR, SEPARATOR_COST = "\n\n/* ... */\n\n", 10


def old_ranges(diff: str) -> list[tuple[int, int]]:
    """1-based first and last old line of every hunk."""
    return [(int(m[1]), int(m[1]) + int(m[2] or 1) - 1) for m in _HUNK.finditer(diff)]


def function_range(lines: list[str], line: int) -> tuple[int, int] | None:
    """0-based first and last line of what looks like the function around a 1-based line."""
    if not 1 <= line <= len(lines):
        return None

    def opens(i: int) -> int | None:
        bare = lines[i].strip()
        if any(p.match(bare) for p in _STARTS):
            return i
        return i - 1 if bare == "{" and i and _CALL.match(lines[i - 1].strip()) else None

    first = next((s for s in map(opens, range(line - 1, max(-1, line - 1 - BACK), -1)) if s is not None), None)
    if first is None:
        return None
    scope = lines[first : first + AHEAD]
    depth = list(accumulate(x.count("{") - x.count("}") for x in scope))
    opened = list(accumulate(("{" in x for x in scope), max))
    last = next((i for i, d in enumerate(depth) if opened[i] and d == 0), None)
    return first, min(len(lines) - 1, first + SPAN) if last is None else first + last


def merged(ranges: list[tuple[int, int]], gap: int = GAP) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + gap:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out


def pieces(code: str | None, diff: str | None, limit: int) -> tuple[list[tuple[int, int]], bool]:
    """Places of code (from, to) around what a diff changes, and whether a marker says that the last was cut."""
    ranges = old_ranges(diff) if code and diff else []
    if not ranges:
        return [(0, min(limit, len(code or "")))], False
    lines = code.split("\n")
    starts = list(accumulate((len(x) + 1 for x in lines), initial=0))

    def place(first: int, last: int) -> tuple[int, int]:
        first, last = max(0, first), min(len(lines), last)
        return (starts[first], starts[last] - 1) if first < last else (0, 0)

    found = merged([r for r in (function_range(lines, first) for first, _ in ranges) if r])
    if found:
        parts, used = [], 0
        for first, last in found:
            a, b = place(first - AROUND_FUNCTION, last + AROUND_FUNCTION)
            if used + b - a + SEPARATOR_COST > limit:
                if not parts:
                    parts.append((a, min(b, a + limit)))
                break
            parts.append((a, b))
            used += b - a + SEPARATOR_COST
        if sum(b - a for a, b in parts) + len(SEPARATOR) * (len(parts) - 1) <= limit:
            return parts, False
    touched = [(a, b) for a, b in ranges if a <= b]
    if not touched:
        return [(0, min(limit, len(code)))], False
    first, last = min(a for a, _ in touched) - 1, max(b for _, b in touched) - 1
    a, b = place(first - AROUND_CHANGE, last + AROUND_CHANGE)
    if b - a <= limit:
        return [(a, b)], False
    at = code.rfind("\n", a, a + limit) - a
    return [(a, a + (at if at > limit * 0.9 else limit))], True


def region(code: str | None, diff: str | None, limit: int) -> str:
    places, marked = pieces(code, diff, limit)
    return SEPARATOR.join((code or "")[a:b] for a, b in places) + (config.TRUNCATED_INPUT if marked else "")


@F.pandas_udf(StringType())  # a type by name would need a session, which workers lack
def changed_region(code: pd.Series, diff: pd.Series, limit: pd.Series) -> pd.Series:
    return pd.Series([region(c, d, int(n)) for c, d, n in zip(code, diff, limit, strict=True)], dtype=object)


@F.pandas_udf(ArrayType(IntegerType()))
def changed_places(code: pd.Series, diff: pd.Series, limit: pd.Series) -> pd.Series:
    """What region() is made of: 1 if it ends in the marker, else 0, then the start and length of each piece."""
    found = (pieces(c, d, int(n)) for c, d, n in zip(code, diff, limit, strict=True))
    return pd.Series([[int(marked), *(n for a, b in places for n in (a, b - a))] for places, marked in found], dtype=object)


def region_of(code: Column, places: Column) -> Column:
    """The region of code that changed_places() found."""
    part = lambda i: F.substring(code, F.get(places, i) + 1, F.get(places, i + 1))
    one = F.substring(code, F.get(places, F.lit(1)) + 1, F.get(places, F.lit(2)))
    more = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.size(places) - 2, F.lit(1)), F.lit(2)), part), SEPARATOR)
    return F.concat(F.when(F.size(places) <= 3, one).otherwise(more), F.when(F.get(places, F.lit(0)) == 1, config.TRUNCATED_INPUT).otherwise(""))


def merge_ranges(rows: DataFrame, key: str, first: str = "first", last: str = "last", gap: int = GAP) -> DataFrame:
    """Ranges of each key that overlap or lie within `gap` of each other become one: gaps and islands."""
    order = Window.partitionBy(key).orderBy(first, last)
    reach = F.max(last).over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col(first) <= reach + gap, 0).otherwise(1)).over(order)
    return rows.withColumn("_island", island).groupBy(key, "_island").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_island")

"""Attributes of a unified diff."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HUNK = r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@"


def lines(diff: Column) -> Column:
    return F.split(diff, "\n", -1)


def lines_added(diff: Column) -> Column:
    return F.size(F.filter(lines(diff), lambda x: x.startswith("+") & ~x.startswith("+++")))


def lines_deleted(diff: Column) -> Column:
    return F.size(F.filter(lines(diff), lambda x: x.startswith("-") & ~x.startswith("---")))


def hunks(diff: Column) -> Column:
    """Array of (start, count, end) of the old side; a count left out is 1."""
    starts, counts = (F.regexp_extract_all(diff, F.lit(HUNK), F.lit(k)) for k in (1, 2))

    def hunk(a, b):
        start, count = a.try_cast("int"), F.coalesce(F.nullif(b, F.lit("")).try_cast("int"), F.lit(1))
        return F.struct(start.alias("start"), count.alias("count"), (start + count - 1).alias("end"))

    return F.zip_with(starts, counts, hunk)


def is_diff(text: Column) -> Column:
    """Has a hunk mark or a file header, and a plus or minus."""
    header = text.contains("diff --git") | text.startswith("@@") | text.contains("@@ ")
    return header & (text.contains("+") | text.contains("-"))


def header_range(diff: Column) -> Column:
    """The range text between the first pair of @@; 'unknown' without one."""
    start = F.instr(diff, "@@") + 2
    end = F.position(F.lit("@@"), diff, start)
    return F.when((start > 2) & (end > 0), F.trim(F.substring(diff, start, end - start))).otherwise(F.lit("unknown"))


def header_function(diff: Column) -> Column:
    """What git writes behind the first hunk's range; 'unknown' if nothing."""
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(diff, r"@@ [^@\n]*@@([^\n]*)", 1)), F.lit("")), F.lit("unknown"))

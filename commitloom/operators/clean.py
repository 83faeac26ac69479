"""Cleaning of instructions, inputs and outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from ..functions import text
from .context import changed_region, region_of


def instruction(c: Column) -> Column:
    """Stripped as a whole, then every line on its right."""
    return F.array_join(F.transform(F.split(text.strip(c), "\n", -1), text.rstrip), "\n")


def source(c: Column, limit: int = config.INPUT_CUT) -> Column:
    """Code without a diff: cut at a closing brace or a line end near the limit, with a marker; '' for null."""
    whole = text.strip(F.coalesce(c, F.lit("")))
    cut = F.substring(whole, 1, limit)
    brace, line = text.last_index(cut, "\n}"), text.last_index(cut, "\n")
    shorter = F.when(brace > limit * 0.7, F.substring(cut, F.lit(1), brace + 2)).when(line > limit * 0.9, F.substring(cut, F.lit(1), line)).otherwise(cut)
    return F.when(F.length(whole) <= limit, whole).otherwise(F.concat(shorter, F.lit(config.TRUNCATED_INPUT)))


def source_for(code: Column, diff: Column, limit: int = config.INPUT_CUT, places: Column | None = None) -> Column:
    """Code around what a diff changes; without a diff as source(). places: what context.changed_places() found for this limit, if that was asked for before."""
    around = changed_region(code, diff, F.lit(limit)) if places is None else region_of(code, places)
    return F.when(F.coalesce(code, F.lit("")) == "", F.lit("")).when(F.coalesce(diff, F.lit("")) == "", source(code, limit)).otherwise(around)


def output(c: Column, limit: int = config.OUTPUT_CUT) -> Column:
    """A diff cut at its last hunk near the limit; '' for null."""
    whole = text.strip(F.coalesce(c, F.lit("")))
    cut = F.substring(whole, 1, limit)
    hunk = text.last_index(cut, "\n@@")
    return F.when(F.length(whole) <= limit, whole).when(hunk > limit * 0.7, F.substring(cut, F.lit(1), hunk)).otherwise(cut)

"""Validation of examples and coverage of diffs by their inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import diffs, text


def invalid_reason(instruction: Column, source: Column, output: Column, strict: bool = True) -> Column:
    """The first rule that an example breaks; null if none."""
    i, s, o = (F.coalesce(c, F.lit("")) for c in (instruction, source, output))
    n = lambda c: F.length(c).cast("string")
    say = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    rules = [
        (F.length(text.strip(i)) < config.MIN_INSTRUCTION, say("Instruction too short (", n(i), f" < {config.MIN_INSTRUCTION})")),
        (F.length(text.strip(o)) < config.MIN_OUTPUT, say("Output too short (", n(o), f" < {config.MIN_OUTPUT})")),
        (F.length(o) > config.MAX_OUTPUT, say("Output too long (", n(o), f" > {config.MAX_OUTPUT})")),
        (F.length(text.strip(s)) < config.MIN_INPUT, say("Input too short or empty (", n(s), " chars)")),
    ]
    merge = text.with_lower(i, lambda _, low: F.coalesce(*(F.when(low.contains(p.lower()), p) for p in config.MERGE_PHRASES)))
    rules.append((merge.isNotNull(), say("Merge commit detected: '", merge, "'")))
    if strict:
        first = F.lower(F.get(F.split(i, "\n", 2), F.lit(0)))
        rules += [(~i.contains("\n"), say("Instruction has no body (single line)")), (~diffs.is_diff(o), say("Output is not a valid diff format"))]
        rules += [(first.contains(p), say(f"Trivial change detected: '{p}'")) for p in config.TRIVIAL_WORDS]
    return F.coalesce(*(F.when(broken, reason) for broken, reason in rules))


def valid_message(instruction: Column, strict: bool = True) -> Column:
    """Whether no rule on instructions is broken. Each rule reads one field, so the others are given as good ones."""
    return invalid_reason(instruction, F.lit("x" * config.MIN_INPUT), F.lit("diff --git " + "+" * config.MIN_OUTPUT), strict).isNull()


def valid_change(source: Column, output: Column, strict: bool = True) -> Column:
    """Whether no rule on inputs and outputs is broken."""
    return invalid_reason(F.lit("x" * config.MIN_INSTRUCTION + "\n"), source, output, strict).isNull()


def with_reason(examples: DataFrame, strict: bool = True) -> DataFrame:
    return examples.withColumn("reason", invalid_reason(F.col("instruction"), F.col("input"), F.col("output"), strict))


def summary(checked: DataFrame) -> DataFrame:
    """Totals and counts of an example table with reasons or, in its place, valid."""
    valid = F.col("valid") if "valid" in checked.columns else F.col("reason").isNull()
    return checked.agg(F.count("*").alias("total"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))


def quality_report(examples: DataFrame) -> DataFrame:
    """Validity and completeness in percent, grades, lengths and the token estimate of one pass over examples."""
    filled = [F.length(text.strip(F.coalesce(c, F.lit("")))) > 0 for c in ("instruction", "input", "output")]
    lengths = [F.length(F.coalesce(c, F.lit(""))) for c in ("instruction", "input", "output")]
    totals = examples.agg(
        F.count("*").alias("total"),
        F.count_if(filled[0] & filled[2]).alias("valid"),
        F.count_if(~filled[1]).alias("empty_input"),
        *(f(n).alias(f"{name}_{c}") for c, n in zip(("instruction", "input", "output"), lengths, strict=True) for name, f in (("min", F.min), ("max", F.max), ("avg", F.avg))),
        (F.sum(sum(lengths, F.lit(0))) / 4).alias("estimated_tokens"),
    )
    share = lambda c: F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("total")), F.lit(0.0))
    rows = totals.withColumn("valid_percent", share("valid")).withColumn("empty_percent", share("empty_input"))
    grade = F.when(F.col("valid_percent") >= 99, "excellent").when(F.col("valid_percent") >= 95, "good").otherwise("poor")
    gaps = F.when(F.col("empty_percent") <= 1, "excellent").when(F.col("empty_percent") <= 5, "good").otherwise("poor")
    return rows.withColumn("validity_grade", grade).withColumn("completeness_grade", gaps)


def entry_row(examples: DataFrame, fields: tuple[str, ...] = ("instruction", "input", "output")) -> DataFrame:
    """Presence and lengths of each field of every example."""
    parts = []
    for c in fields:
        body = F.coalesce(c, F.lit(""))
        parts += [text.some_text(body).alias(f"has_{c}"), F.length(body).alias(f"{c}_length")]
    return examples.select("*", *parts)


def is_truncated(source: Column, output: Column) -> Column:
    return (F.length(source) >= 7999) | (F.length(output) >= 11999)


def _lines(c: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(diffs.lines(c), text.strip), lambda x: x != ""))


def context_lines(diff: Column) -> Column:
    """Distinct stripped lines that the old file must hold: unchanged and deleted ones."""
    headers = ("diff ", "index ", "---", "+++", "@@", "+")

    def wanted(x):
        skip = F.lit(False)
        for h in headers:
            skip = skip | x.startswith(h)
        return ~skip

    bare = F.transform(F.filter(diffs.lines(diff), wanted), lambda x: text.strip(F.when(x.startswith("-"), F.substring(x, 2, 1 << 30)).otherwise(x)))
    return F.array_distinct(F.filter(bare, lambda x: x != ""))


def changed_lines(diff: Column, most: int | None = None) -> Column:
    """Stripped added and deleted lines, the first `most` or all, in order, repeats kept."""
    real = lambda x: (x.startswith("+") & ~x.startswith("+++")) | (x.startswith("-") & ~x.startswith("---"))
    found = F.filter(diffs.lines(diff), real)
    return F.transform(found if most is None else F.slice(found, 1, most), lambda x: text.strip(F.substring(x, 2, 1 << 30)))


def _squeezed(c: Column) -> Column:
    return text.strip(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def smart_coverage(source: Column, diff: Column) -> Column:
    """Of the context lines: how many the input holds, exactly or with other white space."""
    wanted, have = context_lines(diff), _lines(source)
    loose = F.transform(have, _squeezed)
    pairs = F.transform(wanted, lambda c: F.struct(c.alias("line"), _squeezed(c).alias("loose")))  # squeezed once, not for each line of the input
    near = lambda p: F.exists(loose, lambda i: i.contains(p["loose"]) | p["loose"].contains(i))
    missing = F.transform(F.filter(pairs, lambda p: ~(F.array_contains(have, p["line"]) | near(p))), lambda p: p["line"])
    return _coverage(F.size(wanted), F.size(wanted) - F.size(missing), F.slice(missing, 1, 5))


def changed_coverage(source: Column, diff: Column) -> Column:
    """Of the distinct changed lines: how many hold a line of the input or are held by one."""
    wanted, have = F.array_distinct(F.filter(changed_lines(diff), lambda x: x != "")), _lines(source)
    missing = F.filter(wanted, lambda c: ~F.exists(have, lambda i: i.contains(c) | c.contains(i)))
    return _coverage(F.size(wanted), F.size(wanted) - F.size(missing), missing)


def _coverage(total: Column, found: Column, missing: Column) -> Column:
    return F.struct(total.alias("total"), found.alias("found"), F.coalesce(F.try_divide(found * 100.0, total), F.lit(0.0)).alias("percent"), missing.alias("missing"))


def sample_coverage(extracted: Column, diff: Column, n: int = 10) -> Column:
    """Percent of the first n changed lines found in a text, and the verdict. The lines and the percentage are made once for a row."""

    def verdict(found: Column, percent: Column) -> Column:
        return F.struct(found.alias("found"), percent.alias("percent"), F.when(percent >= 80, "PASS").when(percent >= 50, "WARN").otherwise("FAIL").alias("verdict"))

    held = lambda first: F.size(F.filter(first, lambda x: (x != "") & extracted.contains(x)))
    counts = F.transform(F.array(changed_lines(diff, n)), lambda first: F.struct(held(first).alias("found"), F.size(first).alias("lines")))
    shares = F.transform(counts, lambda s: F.struct(s["found"].alias("found"), F.coalesce(F.try_divide(s["found"] * 100.0, s["lines"]), F.lit(0.0)).alias("percent")))
    return F.get(F.transform(shares, lambda s: verdict(s["found"], s["percent"])), F.lit(0))


def coverage_grade(percent: Column) -> Column:
    return F.when(percent >= 90, "PASS").when(percent >= 75, "GOOD").when(percent >= 50, "WARN").otherwise("FAIL")


def coverage_summary(rows: DataFrame, percent: str = "percent") -> DataFrame:
    p = F.col(percent)
    return rows.agg(F.count("*").alias("entries"), F.avg(p).alias("average"), F.count_if(p >= 90).alias("at_90"), F.count_if((p >= 75) & (p < 90)).alias("at_75"), F.count_if((p >= 50) & (p < 75)).alias("at_50"), F.count_if(p < 50).alias("below_50"), F.count_if(p >= 80).alias("at_80"))


def same_start(a: Column, b: Column, n: int = 500) -> Column:
    return F.substring(a, 1, n) == F.substring(b, 1, n)


def looks_like_code(source: Column) -> Column:
    """Has a type or storage word and both braces."""
    word = source.contains("static") | source.contains("int ") | source.contains("void ")
    return word & source.contains("{") & source.contains("}")

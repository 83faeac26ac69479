"""Heuristic scores, tags, author expertise, model replies and answers: expressions, no Python in the plan."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import text


def _some(c: str) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def has_rationale(body: Column) -> Column:
    return text.with_lower(body, lambda c, low: text.matches(c, text.any_word(config.RATIONALE_WORDS), low))


def heuristic_score(weights: dict[str, int] = config.WEIGHTS, known: bool = False) -> Column:
    """0 to 100, of a commit row. known: the row has body_length and body_rationale, so the body is not read."""
    files = F.coalesce(F.col("files_changed"), F.lit(0))
    message_length = F.length("subject") + 1 + (F.col("body_length") if known else F.length("body"))
    gains = [
        (_some("signed_off_by"), "signed_off"),
        (_some("reviewed_by"), "reviewed_by"),
        (_some("acked_by"), "acked_by"),
        (F.coalesce(F.col("fixes_hash"), F.lit("")) != "", "fixes_tag"),
        (message_length > 200, "long_message"),
        (F.col("body_rationale") if known else has_rationale(F.col("body")), "has_rationale"),
        (text.with_lower(F.col("subject"), lambda c, low: text.matches(c, text.any_word(config.TRIVIAL_WORDS), low)), "trivial_subject"),
        (files.between(1, 5), "optimal_size"),
        (files > 20, "too_many_files"),
    ]
    total = F.lit(weights["base"])
    for condition, name in gains:
        total = total + F.when(condition, weights[name]).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("double")


def with_score(commits: DataFrame, only_missing: bool = False) -> DataFrame:
    """heuristic_score added, or filled in where it is 0."""
    score = heuristic_score(known={"body_length", "body_rationale"} <= set(commits.columns))
    if only_missing:
        score = F.when(F.coalesce(F.col("heuristic_score"), F.lit(0.0)) == 0, score).otherwise(F.col("heuristic_score"))
    return commits.withColumn("heuristic_score", score)


def flags(subject: Column, message: Column) -> Column:
    """Bits of the rules that match; subject and message are structs of a text and the same in lower case."""
    total = F.lit(0)
    for bit, tag, pattern in config.TAG_RULES:
        where = subject if tag in config.SUBJECT_TAGS else message
        total = total + F.when(text.matches(where["text"], pattern, where["low"]), bit).otherwise(0)
    return total


def message_flags(c: Column) -> Column:
    """Bits of the rules for messages that match a part of one, whole lines of it: no pattern of them holds or borders on a line end."""
    texts = F.array(F.struct(c.alias("text"), F.lower(c).alias("low")))
    rules = [(bit, pattern) for bit, tag, pattern in config.TAG_RULES if tag not in config.SUBJECT_TAGS]
    return F.get(F.transform(texts, lambda t: sum((F.when(text.matches(t["text"], p, t["low"]), bit).otherwise(0) for bit, p in rules), F.lit(0))), F.lit(0))


def tag_names(bits: Column) -> Column:
    return F.array_compact(F.array(*(F.when(bits.bitwiseAND(bit) > 0, F.lit(tag)) for bit, tag, _ in config.TAG_RULES)))


def with_tags(commits: DataFrame) -> DataFrame:
    """flags and tags added, 0 and no tags where no rule matches.

    The rules run inside a generator, which the optimizer neither copies into filters nor into every use of the flags.
    Where rows have body_flags, the body is not read.
    """
    known = "body_flags" in commits.columns
    message = F.col("subject") if known else F.concat(F.col("subject"), F.lit("\n"), F.col("body"))
    both = lambda c: F.struct(c.alias("text"), F.lower(c).alias("low"))
    texts = F.array(F.struct(both(F.col("subject")).alias("subject"), both(message).alias("message"), (F.col("body_flags") if known else F.lit(0)).alias("more")))
    bits = F.transform(texts, lambda t: F.coalesce(flags(t["subject"], t["message"]).bitwiseOR(t["more"]), F.lit(0)))
    return commits.select("*", F.inline(F.transform(bits, lambda b: F.struct(b.alias("flags"), tag_names(b).alias("tags")))))


def commit_tags(commits: DataFrame) -> DataFrame:
    """commit_hash, flags, tags of the commits that have any."""
    return with_tags(commits.select("commit_hash", "subject", "body")).where("flags > 0").select("commit_hash", "flags", "tags")


def author_expertise(commits: DataFrame, maintainers: dict[str, int] = config.MAINTAINERS) -> DataFrame:
    """Of authors with two commits or more: capped logarithm of the count, capped years of whole days, share of a maintainer's weight."""
    rows = commits.groupBy("author_email").agg(F.count("*").cast("int").alias("commit_count"), F.min("author_date").alias("first_commit"), F.max("author_date").alias("last_commit"))
    seconds = F.unix_timestamp(F.col("last_commit").cast("timestamp")) - F.unix_timestamp(F.col("first_commit").cast("timestamp"))
    weight = F.element_at(F.create_map(*map(F.lit, chain.from_iterable(maintainers.items()))), F.lower("author_email")) if maintainers else F.lit(None)
    points = F.least(F.lit(50.0), F.log10(F.col("commit_count") + 1) * 20)
    years = F.least(F.lit(30.0), F.floor(seconds / 86400) / 365 * 3)
    rows = rows.where("commit_count > 1").withColumn("weight", weight)
    score = F.round(points + years + F.coalesce(F.col("weight") * 0.2, F.lit(0.0)), 2)
    return rows.select("author_email", "commit_count", F.array().cast("array<string>").alias("subsystems"), "first_commit", "last_commit", score.alias("expertise_score"), F.col("weight").isNotNull().cast("int").alias("is_maintainer"))


def parse_reply(reply: Column) -> tuple[Column, Column]:
    """(score, reason) of a model's reply: its first JSON object if the score is in 1 to 5, else the first digit 1 to 5."""
    block = F.regexp_extract(reply, r"\{[^}]+\}", 0)
    fields = F.from_json(F.nullif(block, F.lit("")), "map<string,string>")
    raw = F.element_at(fields, "score")
    score = raw.try_cast("double")
    usable = fields.isNotNull() & score.between(1, 5)
    broken = fields.isNotNull() & raw.isNotNull() & score.isNull()
    digit = F.nullif(F.regexp_extract(reply, "[1-5]", 0), F.lit("")).try_cast("double")
    value = F.when(usable, score).when(~F.coalesce(broken, F.lit(False)), digit)
    reason = F.when(usable, F.coalesce(F.element_at(fields, "reason"), F.lit(""))).when(value.isNotNull(), F.substring(reply, 1, 200))
    return value, reason


def agreement(heuristic: Column, model: Column) -> Column:
    gap = F.abs(model - heuristic / 100 * 5)
    return F.when(gap < 1, "agree").when(gap < 2, "close").when(gap.isNotNull(), "differ")


def rubric(response: Column, category: Column) -> Column:
    """Five 0/1 marks of an answer."""
    has = response.contains("diff --git") | response.contains("@@")
    low, words = F.lower(response), F.lit(False)
    for name, keys in config.CATEGORY_WORDS.items():
        hit = F.lit(False)
        for k in keys:
            hit = hit | low.contains(k.lower())
        words = words | ((category == name) & hit)
    marks = sum((response.contains(p).cast("int") for p in config.STYLE_MARKS), F.lit(0))
    return F.struct(
        has.cast("int").alias("has_diff"),
        (has & response.contains("---") & response.contains("+++")).cast("int").alias("diff_format"),
        (text.count_of(response, "\n ") > 2).cast("int").alias("has_context"),
        F.coalesce(words, F.lit(False)).cast("int").alias("addresses_issue"),
        (marks >= 2).cast("int").alias("kernel_style"),
    )


def compare_models(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Per test: both sums and the winner. Inputs: id, category, response."""

    def total(df: DataFrame, name: str) -> DataFrame:
        s = rubric(F.col("response"), F.col("category"))
        return df.select("id", F.col("category"), sum((s[k] for k in ("has_diff", "diff_format", "has_context", "addresses_issue", "kernel_style")), F.lit(0)).alias(name))

    both = total(base, "base_score").join(total(tuned, "tuned_score").drop("category"), "id")
    winner = F.when(F.col("tuned_score") > F.col("base_score"), "tuned").when(F.col("base_score") > F.col("tuned_score"), "base").otherwise("tie")
    return both.withColumn("winner", winner)


def improvement(compared: DataFrame) -> DataFrame:
    """Totals, overall winner and the improvement in percent (100 from nothing)."""
    sums = compared.agg(F.sum("base_score").alias("base_total"), F.sum("tuned_score").alias("tuned_total"))
    b, t = F.col("base_total"), F.col("tuned_total")
    winner = F.when(t > b, "tuned").when(b > t, "base").otherwise("tie")
    return sums.withColumn("winner", winner).withColumn("improvement", F.when(t > b, F.when(b > 0, (t - b) / b * 100).otherwise(F.lit(100.0))))

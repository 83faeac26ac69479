"""Statistics of commit tables and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def commit_counts(commits: DataFrame) -> DataFrame:
    """Every commit metric in one pass."""
    score, ai = F.col("heuristic_score"), F.col("ai_quality_score")
    body = F.coalesce("body", F.lit(""))
    metrics = {
        "total": F.lit(True),
        "non_merge": F.col("is_merge") == 0,
        "scored": score > 0,
        "unscored": score == 0,
        "ai_scored": ai.between(1, 5),
        "ai_skipped": ai == -1,
        "ai_pending": ai.isNull() & (score >= 30),
        "with_reason": F.coalesce("ai_score_reason", F.lit("")) != "",
        "tier_90": score >= 90,
        "tier_70": score >= 70,
        "tier_50": score >= 50,
        "short_body": text.byte_length(body) < 150,
        "few_files": F.col("files_changed").between(1, 5),
        "has_fixes": F.coalesce("fixes_hash", F.lit("")) != "",
        "is_revert": F.col("subject").startswith('Revert "'),
    }
    return commits.agg(*(F.count_if(c).alias(name) for name, c in metrics.items()))


def ai_progress(commits: DataFrame) -> DataFrame:
    """Percent scored of what is scored or pending; 0 of nothing."""
    c = commit_counts(commits).select(F.col("ai_scored").alias("done"), F.col("ai_pending").alias("pending"))
    return c.withColumn("percent", F.coalesce(F.try_divide(F.col("done") * 100.0, F.col("done") + F.col("pending")), F.lit(0.0)))


def top_subsystems(files: DataFrame, n: int = 20) -> DataFrame:
    return files.groupBy("subsystem").agg(F.count("*").alias("changes")).orderBy(F.desc("changes"), "subsystem").limit(n)


def line_histogram(files: DataFrame) -> DataFrame:
    """File changes by lines changed, in the order of the labels as text."""
    n = F.col("lines_added") + F.col("lines_deleted")
    label = F.when(n < 10, "0-10").when(n < 50, "10-50").when(n < 100, "50-100").when(n < 500, "100-500").otherwise("500+")
    return files.groupBy(label.alias("bucket")).agg(F.count("*").alias("changes")).orderBy("bucket")


def files_per_commit(commits: DataFrame, files: DataFrame, least: float = 90, n: int = 20) -> DataFrame:
    rows = commits.where(F.col("heuristic_score") >= least).select("commit_hash", "subject")
    counts = files.groupBy("commit_hash").agg(F.count("*").alias("files"))
    return rows.join(counts, "commit_hash").orderBy(F.desc("files"), "commit_hash").limit(n)


def average_files(commits: DataFrame, files: DataFrame, least: float = 90) -> DataFrame:
    chosen = commits.where(F.col("heuristic_score") >= least).select("commit_hash")
    return files.join(chosen, "commit_hash", "left_semi").groupBy("commit_hash").count().agg(F.avg("count").alias("average_files"))


def model_scores(commits: DataFrame) -> DataFrame:
    """Commits of each model score; unscored ones are a group."""
    return commits.groupBy("ai_quality_score").agg(F.count("*").alias("commits"))


def score_distribution(commits: DataFrame, n: int = 20) -> DataFrame:
    """Commonest heuristic scores with their share in percent."""
    counts = commits.groupBy("heuristic_score").agg(F.count("*").alias("commits"))
    share = F.col("commits") * 100.0 / F.sum("commits").over(Window.partitionBy())  # one row for each score
    return counts.withColumn("percent", share).orderBy(F.desc("commits"), "heuristic_score").limit(n)


def score_ranges(commits: DataFrame) -> DataFrame:
    s, m = F.col("heuristic_score"), F.when(F.col("ai_quality_score").between(1, 5), F.col("ai_quality_score"))
    return commits.agg(F.min(s).alias("least"), F.max(s).alias("most"), F.avg(s).alias("average"), F.min(m).alias("ai_least"), F.max(m).alias("ai_most"), F.avg(m).alias("ai_average"))


def top_authors(expertise: DataFrame, n: int = 10) -> DataFrame:
    return expertise.orderBy(F.desc("expertise_score"), "author_email").limit(n)


def best_reviews(commits: DataFrame, n: int = 15) -> DataFrame:
    """Highest model scores with short hash, cut subject and stars."""
    rows = commits.where(F.col("ai_quality_score").between(1, 5)).orderBy(F.desc("ai_quality_score"), F.desc("heuristic_score"), "commit_hash").limit(n)
    return rows.select(F.substring("commit_hash", 1, 12).alias("short_hash"), F.substring("subject", 1, 60).alias("short_subject"), "ai_quality_score", stars(F.col("ai_quality_score")).alias("stars"))


def stars(score: Column) -> Column:
    n = score.cast("int")
    return F.concat(F.repeat(F.lit("*"), n), F.repeat(F.lit("-"), 5 - n))


def top_values(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("entries")).orderBy(F.desc("entries"), F.col(column).asc_nulls_last()).limit(n)


def sizes(examples: DataFrame) -> DataFrame:
    n = [F.length(F.coalesce(c, F.lit(""))) for c in ("input", "output")]
    return examples.agg(F.avg(n[0]).alias("average_input"), F.avg(n[1]).alias("average_output"))


#: Upper bounds of the size categories that dataset hubs use.
SIZES = ((1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"))
FIELDS = {"instruction": "commit message that explains the change", "input": "code around the changed lines", "output": "unified diff"}
REASONING_FIELDS = {"quality_score": "score that a model gave, 1 to 5", "quality_reason": "the model's reason"}


def dataset_card(
    title: str, counts: dict[str, int], descriptions: dict[str, str] | None = None, license: str = "other", languages: tuple[str, ...] = ("en",), tags: tuple[str, ...] = (), metrics: dict[str, float] | None = None, date: str | None = None
) -> str:
    """A Markdown card with front matter: tiers with their counts and what they are, fields, usage and measured metrics.

    counts are one number for each tier, metrics values that a report has measured (rounded to two places); a part without content is left out.
    """
    total = sum(counts.values())
    size = next((name for most, name in SIZES if total < most), "n>10M")
    listed = lambda name, items: [f"{name}:", *(f"- {i}" for i in items)] if items else []
    front = ["---", f"license: {license}", *listed("language", languages), *listed("tags", tags), *listed("size_categories", (size,)), "---"]
    rows = [f"| {name} | {n:,} |" + (f" {descriptions.get(name, '')} |" if descriptions else "") for name, n in counts.items()]
    heads = ["| tier | records |" + (" description |" if descriptions else ""), "|---|---|" + ("---|" if descriptions else "")]
    first = next(iter(counts), "tier")
    usage = ["## Usage", "", "```python", f'rows = spark.read.json("{first}")', 'rows.select("instruction", "input", "output").show()', "```"]
    fields = ["## Fields", "", *(f"* `{k}`: {v}" for k, v in FIELDS.items()), "", "Reasoning tiers add:", "", *(f"* `{k}`: {v}" for k, v in REASONING_FIELDS.items())]
    measured = ["## Metrics", "", *(f"* {k}: {v:.2f}" for k, v in metrics.items()), ""] if metrics else []
    parts = [*front, "", f"# {title}", "", f"{total:,} records made from version history.", "", "## Tiers", "", *heads, *rows, "", *usage, "", *fields, "", *measured, f"License: {license}"]
    return "\n".join(parts + ([f"\nMade on {date}"] if date else [])) + "\n"

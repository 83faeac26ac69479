"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share all words; none gets more than
``max_copies`` times what it has, and the excess is shared again by weight (the water level has a closed form over the sources
sorted by cap / weight, so no loop runs).

Copies: longer documents are wanted more often, by the number of binary digits of their words (``digits``). A document is to be
taken min(max_copies, c * digits) times on average, with the one c for each source that makes these words meet its target; c
has the same closed form, over the few dozen digit counts of a source. The whole part is certain copies. The fraction p, which
thus differs by document, is its inclusion probability in a sample of fixed size: a document has a uniform number u fixed by
its content, its Pareto rank is the odds of u divided by the odds of p, and documents enter in rank order while their words
fit into what the certain copies leave of the target. One last document closes the gap best. The size that is fixed is that in
words, since the targets are words; the rank at which it is reached lies near 1, where inclusion has the probability p.

No source is ever sorted as a whole, since one may hold a third of all rows: ranks fall into ``BUCKETS`` buckets with partial
sums, and only the bucket in which the target is crossed is ordered. Only one row for each source (and digit count) meets in
one task.

Defined cases: null text or a text without words has size 0 and takes 0 words; a null source is a source of its own; rows that
agree in id and text share their fate; empty input gives empty output; other columns are kept and never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 4096
SEED = 20240607


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, number of words and the fixed uniform number of every row."""
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), shared.n_words(text).alias("size"), uniform(text, seed).alias("u"))


def uniform(text: Column, seed: int = SEED) -> Column:
    """In (0, 1), from id and text: 13 hexadecimal digits of a SHA-1."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), shared.text_or_empty(text))
    return (F.conv(F.substring(F.sha1(key.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def digits(size: Column) -> Column:
    """Binary digits of a size: how much a document is wanted."""
    return F.length(F.bin(size)).cast("double")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: one row for each source."""
    have = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Strings compare by their UTF-8 bytes, which is code-point order. The windows run over one row for each source.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(place, F.lit(len(weights))))
    rows = have.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    rows = rows.withColumn("bend", F.col("cap") / F.col("weight"))
    by_bend = Window.orderBy("bend", F.col("source").asc_nulls_last())
    upto = by_bend.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    full = F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    spent = F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    level = (F.sum("source_size").over(whole) - full) / (F.sum("weight").over(whole) - spent)
    # The level as if all sources before this one were full; the first that isn't full fixes it for the rest.
    rows = rows.withColumn("level", level).withColumn("turn", F.row_number().over(by_bend))
    rows = rows.withColumn("level", F.min(F.when(F.col("level") < F.col("bend"), F.struct("turn", "level"))).over(whole)["level"])
    return rows.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def means(sized: DataFrame, goals: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, digits, source_size, target, mean (copies of such documents on average) and rest (words that certain copies leave)."""
    have = sized.groupBy("source", digits(F.col("size")).alias("digits")).agg(F.sum("size").cast("double").alias("words"))
    rows = have.join(goals.withColumnRenamed("source", "_goal"), F.col("source").eqNullSafe(F.col("_goal"))).drop("_goal")
    # From most to fewest digits: c as if all with more digits had max_copies; the first that stays below fixes it for the rest.
    fall = Window.partitionBy("source").orderBy(F.desc("digits"))
    before = F.coalesce(F.sum("words").over(fall.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum(F.col("digits") * F.col("words")).over(fall.rowsBetween(0, Window.unboundedFollowing))
    c = (F.col("target") - F.lit(float(max_copies)) * before) / F.when(after > 0, after)
    first = F.min(F.when(F.col("c") * F.col("digits") < max_copies, F.struct(-F.col("digits"), "c"))).over(Window.partitionBy("source"))
    rows = rows.withColumn("c", c).withColumn("c", first["c"])
    mean = F.when(F.col("source_size") == 0, F.lit(0.0)).when(F.col("c").isNull(), F.lit(float(max_copies))).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(float(max_copies)), F.col("c") * F.col("digits"))))
    rows = rows.withColumn("mean", mean).withColumn("certain", F.floor(F.col("mean") + F.lit(1e-9)).cast("long"))
    rest = F.col("target") - F.sum(F.col("certain") * F.col("words")).over(Window.partitionBy("source"))
    return rows.select("source", "digits", "source_size", "target", "mean", "certain", rest.alias("rest"))


def _ranked(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of their source and digit count in the plan, Pareto rank and bucket."""
    p = plan.withColumnsRenamed({"source": "_source", "digits": "_digits"})
    rows = sized.join(p, F.col("source").eqNullSafe(F.col("_source")) & (digits(F.col("size")) == F.col("_digits"))).drop("_source", "_digits")
    odds = lambda x: x / (F.lit(1.0) - x)
    part = F.greatest(F.col("mean") - F.col("certain"), F.lit(0.0))
    rows = rows.withColumn("part", part).withColumn("rank", F.when((F.col("part") > 0) & (F.col("size") > 0), odds(F.col("u")) / odds(F.col("part"))))
    return rows.withColumn("bucket", F.floor(F.col("rank") / (F.col("rank") + 1) * F.lit(BUCKETS)).cast("int"))


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row for each source and digit count: target, mean copies and where the source's sample ends."""
    goals = shared.materialise(targets(sized, weights, max_copies).coalesce(1), "mix-targets")
    mean = shared.materialise(means(sized, goals, max_copies).coalesce(1), "mix-means", instead_of=(goals,))
    ranked = _ranked(sized, mean).where(F.col("rank").isNotNull())
    sums = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)  # BUCKETS rows at most
    sums = sums.withColumn("upto", F.sum("words").over(upto)).where(F.col("upto") >= F.col("rest"))
    edge = sums.groupBy("source").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "rest"), "bucket").alias("edge"))
    edge = shared.materialise(edge.select(F.col("source").alias("_edge"), "edge.bucket", "edge.before", "edge.rest").withColumnRenamed("bucket", "edge_bucket").coalesce(1), "mix-edge")
    at = F.col("source").eqNullSafe(F.col("_edge"))
    inside = ranked.drop("rest").join(edge, at & (F.col("bucket") == F.col("edge_bucket")))
    key = F.struct("rank", "doc_id", "u")
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "u")  # ties in all three stand or fall together
    inside = inside.select("source", "before", "rest", key.alias("key"), F.sum("size").over(order).alias("run"))
    fits = F.col("before") + F.col("run") <= F.col("rest")
    last = inside.groupBy("source").agg(F.max(F.when(fits, F.col("key"))).alias("last"), F.max(F.when(fits, F.col("run"))).alias("run"))
    last = last.withColumnRenamed("source", "_last")
    ends = edge.join(last, F.col("_edge").eqNullSafe(F.col("_last")), "left").drop("_last")
    ends = ends.withColumn("gap", F.col("rest") - F.col("before") - F.coalesce(F.col("run"), F.lit(0))).drop("run", "before", "rest")
    ends = shared.materialise(ends.coalesce(1), "mix-ends", instead_of=(edge,))
    beyond = ranked.join(ends, at).where(~_taken())
    miss = F.abs(F.col("size") - F.col("gap"))
    close = beyond.where(miss < F.col("gap")).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "rank", "doc_id", "u")).alias("close"))
    close = close.withColumnRenamed("source", "_close")
    plan = mean.join(ends, at, "left").join(close, F.col("source").eqNullSafe(F.col("_close")), "left")
    plan = plan.select(*mean.columns, "edge_bucket", "last", F.struct("close.rank", "close.doc_id", "close.u").alias("close"))
    return shared.materialise(plan.coalesce(1), "mix-plan", instead_of=(mean, ends))


def _taken() -> Column:
    key = F.struct("rank", "doc_id", "u")
    within = (F.col("bucket") == F.col("edge_bucket")) & F.coalesce(key <= F.col("last"), F.lit(False))
    return F.col("rank").isNotNull() & F.coalesce((F.col("bucket") < F.col("edge_bucket")) | within, F.col("edge_bucket").isNull())


def mix(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with source_size, target and copies."""
    rows = _ranked(sized, plan)
    key = F.struct("rank", "doc_id", "u")
    extra = _taken() | (F.col("rank").isNotNull() & key.eqNullSafe(F.col("close")))
    copies = F.col("certain") + extra.cast("long")
    return rows.withColumn("copies", copies).drop("mean", "certain", "part", "rank", "bucket", "edge_bucket", "last", "close", "rest")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) and copies of every row."""
    sized = shared.materialise(sizes(docs), "mix-sizes")
    mixed = mix(sized, plan_mix(sized, weights, max_copies))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", F.col("target").cast("double"), taken, "copies")


def mixed_corpus(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The mix itself: docs' own columns, a row for each copy."""
    sized = shared.materialise(sizes(docs), "mix-sizes")
    plan = plan_mix(sized, weights, max_copies)
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", F.col("source").cast("string").alias("source"), shared.n_words(F.col("text")).alias("size"), uniform(F.col("text")).alias("u"))
    copies = mix(held, plan)
    return copies.where(F.col("copies") > 0).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")

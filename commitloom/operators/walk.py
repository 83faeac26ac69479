"""Walks over a commit graph: what a ref reaches, and an order in which every parent comes before its children.

A history can be a million commits deep, so nothing goes one step a round. `jumps` holds for each commit its 1st, 2nd, 4th, ...
ancestor along first parents, by doubling; with them a whole line of first parents is walked in as many joins as its length
has binary digits. Other parents are followed between such walks, so rounds grow with how deeply merged branches nest.

The order is by corrected time: a commit's own time, or one more than its parents' largest corrected time if that is later. It differs
from the commit time only where clocks disagree, is later than that of all ancestors, and needs no round at all if no clock does.
Ties go to the smaller hash.

Parents that are not among the commits are left out (shallow histories); repeated rows count once; null times count as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import scratch


def edges(commits: DataFrame) -> DataFrame:
    """node, nth (from 0) and parent of every parent that is among the commits."""
    once = commits.where("commit_hash IS NOT NULL").dropDuplicates(["commit_hash"])
    pairs = once.select(F.col("commit_hash").alias("node"), F.posexplode("parents").alias("nth", "parent"))
    return pairs.join(once.select(F.col("commit_hash").alias("parent")), "parent", "left_semi").select("node", "nth", "parent")


def jumps(links: DataFrame) -> list[DataFrame]:
    """For k from 0: node and up, its ancestor 2^k first parents away, where there is one."""
    found = [scratch.written(links.where("nth = 0").select("node", F.col("parent").alias("up")), "jumps")]
    while True:
        last = found[-1]
        longer = scratch.written(last.join(last.select(F.col("node").alias("up"), F.col("up").alias("far")), "up").select("node", F.col("far").alias("up")), "jumps")
        if longer.isEmpty():
            return found
        found.append(longer)


def reachable(commits: DataFrame, refs: DataFrame) -> DataFrame:
    """commit_hash of refs (commit_hash) and all their ancestors."""
    links = scratch.written(edges(commits), "edges")
    new = refs.select("commit_hash").join(commits.select("commit_hash"), "commit_hash", "left_semi").distinct().select(F.col("commit_hash").alias("node"))
    return _reached(links, jumps(links), new).select(F.col("node").alias("commit_hash"))


def _reached(links: DataFrame, up: list[DataFrame], new: DataFrame) -> DataFrame:
    seen = None
    while True:
        line = new
        for jump in reversed(up):  # every distance is a sum of different powers of two
            line = line.join(jump, "node", "left").select(F.explode(F.array("node", "up")).alias("node")).where("node IS NOT NULL").distinct()
        if seen is not None:
            line = line.join(seen, "node", "left_anti")
        line = scratch.written(line, "walked")
        if line.isEmpty():
            break
        seen = line if seen is None else seen.unionByName(line)
        new = links.where("nth > 0").join(line, "node", "left_semi").select(F.col("parent").alias("node")).distinct().join(seen, "node", "left_anti")
    return line if seen is None else seen


def _own_times(commits: DataFrame) -> DataFrame:
    return commits.where("commit_hash IS NOT NULL").groupBy("commit_hash").agg(F.coalesce(F.max("commit_time"), F.lit(0)).cast("long").alias("time"))


def corrected_times(commits: DataFrame) -> DataFrame:
    """commit_hash and corrected time of all commits (commit_hash, parents, commit_time)."""
    links = scratch.written(edges(commits), "edges")
    best = scratch.written(_own_times(commits).select(F.col("commit_hash").alias("node"), "time"), "times")
    return _corrected(links, best)[0].select(F.col("node").alias("commit_hash"), "time")


def _corrected(links: DataFrame, best: DataFrame) -> tuple[DataFrame, list[DataFrame] | None]:
    """node and corrected time; and the jumps, if they were needed."""
    up = None
    while True:
        above = links.join(best.select(F.col("node").alias("parent"), F.col("time").alias("over")), "parent").groupBy("node").agg((F.max("over") + 1).alias("least"))
        late = scratch.written(best.join(above, "node").where("time < least").select("node", "least"), "late")
        if late.isEmpty():
            return best, up
        best = scratch.written(best.join(late, "node", "left").select("node", F.greatest("time", F.coalesce("least", "time")).alias("time")), "times")
        up = up or jumps(links)
        for k, jump in enumerate(up):
            far = jump.join(best.select(F.col("node").alias("up"), F.col("time").alias("far")), "up").select("node", (F.col("far") + (1 << k)).alias("far"))
            best = scratch.written(best.join(far, "node", "left").select("node", F.greatest("time", F.coalesce("far", "time")).alias("time")), "times")


def walk(commits: DataFrame, refs: DataFrame | None = None, oldest_first: bool = True) -> DataFrame:
    """commit_hash and position (from 0) of what refs (commit_hash) reach, or of all commits."""
    # rounds move numbers instead of hashes, which no shuffle compresses
    own = scratch.written(_own_times(commits).withColumn("node", F.monotonically_increasing_id()), "numbered-commits")
    named = own.select("node", "commit_hash")
    child, parent = named.select(F.col("commit_hash").alias("from"), F.col("node").alias("a")), named.select(F.col("commit_hash").alias("to"), F.col("node").alias("b"))
    links = edges(commits).withColumnsRenamed({"node": "from", "parent": "to"}).join(child, "from").join(parent, "to").select(F.col("a").alias("node"), "nth", F.col("b").alias("parent"))
    links = scratch.written(links, "edges")
    times, up = _corrected(links, own.select("node", "time"))
    if refs is not None:
        new = named.join(refs.select("commit_hash"), "commit_hash", "left_semi").select("node")
        times = times.join(_reached(links, up or jumps(links), new), "node", "left_semi")
    times = scratch.written(times.join(named, "node").select("commit_hash", "time"), "walk-times")
    keys = [F.col("time"), F.col("commit_hash")]
    rows = times.orderBy(*(keys if oldest_first else [k.desc() for k in keys])).select("commit_hash", F.monotonically_increasing_id().alias("at"))
    rows = scratch.written(rows.select("commit_hash", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at")), "walk-order")
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row for each part
    return rows.join(counts.select("part", before.alias("before")), "part").select("commit_hash", (F.col("before") + F.col("at")).alias("position"))

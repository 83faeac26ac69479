"""Edges from fixes and reverts to the commits that they address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX = 12


def _edges(rows: DataFrame, kind: str) -> DataFrame:
    return rows.select(F.col("commit_hash").alias("fix_commit"), F.col("target").alias("buggy_commit"), F.col("subject").alias("fix_subject"), F.col("body").alias("fix_body"), F.lit(kind).alias("chain_type"))


def fix_edges(commits: DataFrame, prefixes: bool = False) -> DataFrame:
    """From commits whose fixes_hash is a commit's full hash; with `prefixes`, shortened hashes are looked up as well."""
    rows = commits.where(F.coalesce(F.col("fixes_hash"), F.lit("")) != "").select("commit_hash", "subject", "body", F.col("fixes_hash").alias("target"))
    if prefixes:
        return _edges(_resolved(rows, commits), "fixes")
    known = commits.select(F.col("commit_hash").alias("target"))
    return _edges(rows.join(known, "target", "left_semi"), "fixes")


def revert_edges(commits: DataFrame) -> DataFrame:
    """From reverts whose body names a commit; a shortened hash is looked up, a full one is taken as it is."""
    target = F.regexp_extract("body", r"This reverts commit ([0-9a-fA-F]{12,40})", 1)
    rows = commits.where(F.col("subject").startswith('Revert "')).select("commit_hash", "subject", "body", target.alias("target")).where("target != ''")
    whole = rows.where(F.length("target") == 40)
    return _edges(whole.unionByName(_resolved(rows.where(F.length("target") < 40), commits)), "revert")


def _resolved(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """target replaced by the least hash that starts with it, by an equi-join on the shortest prefix; rows without one go."""
    known = commits.select(F.col("commit_hash").alias("full"), F.substring("commit_hash", 1, PREFIX).alias("head"))
    found = rows.withColumn("head", F.substring("target", 1, PREFIX)).join(known, "head").where(F.col("full").startswith(F.col("target")))
    return found.groupBy("commit_hash", "subject", "body").agg(F.min("full").alias("target"))


def chains(commits: DataFrame, prefixes: bool = False) -> DataFrame:
    return fix_edges(commits, prefixes).unionByName(revert_edges(commits))

"""Stored tables that are updated: files clustered by key, a manifest for each version, copy on write, reading by pages.

`path`/data holds Parquet files, sorted and ranged by the key; `path`/manifests/version=N lists the files of a version with their least
and largest keys and row counts. An update rewrites only the files that hold one of its keys and writes the next manifest, which names
the new files beside the old ones that nothing touched. So readers of an older version still find all its files, and a writer that
loses a race fails on the manifest, since it never replaces one.

The driver sees the manifest, which has a row for each file, and never a row of the table. Keys are compared as Spark orders them; rows
without key stay in the first file and are never updated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def _manifest(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """A row for each file of a folder."""
    rows = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("file"), F.col(f"`{key}`").alias("key"))
    return rows.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))


def _save(manifest: DataFrame, path: str, version: int) -> None:
    manifest.coalesce(1).write.mode("error").parquet(f"{path}/manifests/version={version}")


def _store(rows: DataFrame, path: str, key: str, files: int) -> str:
    folder = f"{path}/data/{uuid.uuid4().hex}"
    rows.repartitionByRange(files, F.col(f"`{key}`")).sortWithinPartitions(F.col(f"`{key}`")).write.option("compression", "zstd").parquet(folder)
    return folder


def versions(spark: SparkSession, path: str) -> list[int]:
    """All versions, oldest first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    found = [s.getPath() for s in system.listStatus(root)]
    done = [p for p in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """file, low, high and n of every file of a version, the newest by default."""
    version = versions(spark, path)[-1] if version is None else version
    return spark.read.parquet(f"{path}/manifests/version={version}")


def create(rows: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Version 1 of a table, in `files` files or one for ROWS_PER_FILE rows."""
    spark = rows.sparkSession
    if versions(spark, path):
        raise ValueError(f"{path} holds a table already")
    files = files or max(1, -(-rows.count() // ROWS_PER_FILE))
    _save(_manifest(spark, _store(rows, path, key, files), key), path, 1)


def _files(listed: DataFrame) -> list[str]:
    return [r.file for r in listed.select("file").orderBy("low", "file").collect()]  # a row for each file


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(*_files(manifest(spark, path, version)))


def update(spark: SparkSession, path: str, changes: DataFrame, key: str) -> tuple[int, int]:
    """Columns of changes replace those of the rows of equal key, as the next version; (files rewritten, files of the table).

    Keys that the table lacks are ignored; of several changes of a key the row that sorts first by its columns, nulls first, counts. A null sets null.
    """
    version = versions(spark, path)[-1]
    listed = manifest(spark, path, version)
    table = read(spark, path, version)
    new = [c for c in changes.columns if c != key]
    unknown = sorted(set(new) - set(table.columns))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    taken = F.min(F.struct(*(F.col(f"`{c}`") for c in new))).alias("new")
    changes = changes.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("changed")).agg(taken)
    # only keys are read to find the files
    keys = table.select(F.col("_metadata.file_path").alias("file"), F.col(f"`{key}`").alias("changed"))
    touched = [r.file for r in keys.join(changes.select("changed"), "changed", "left_semi").select("file").distinct().collect()]  # a row for each file
    total = listed.count()
    if not touched:
        return 0, total
    old = spark.read.schema(table.schema).parquet(*touched)
    met = old.join(changes, old[key] == changes["changed"], "left")
    columns = [F.when(F.col("changed").isNotNull(), F.col(f"new.`{c}`")).otherwise(old[c]).cast(table.schema[c].dataType).alias(c) if c in new else old[c] for c in table.columns]
    fresh = _manifest(spark, _store(met.select(*columns), path, key, len(touched)), key)
    _save(listed.where(~F.col("file").isin(touched)).unionByName(fresh), path, version + 1)
    return len(touched), total


def page_files(spark: SparkSession, path: str, after, size: int, version: int | None = None) -> list[str]:
    """The files that can hold the `size` rows that follow key `after` (None: from the start)."""
    left, found, reach = size, [], None
    for r in manifest(spark, path, version).orderBy("low", "high", "file").collect():  # a row for each file
        if after is not None and (r.high is None or r.high <= after):
            continue
        if left <= 0 and (reach is None or r.low is None or r.low > reach):
            break  # files that begin behind all rows counted so far
        found.append(r.file)
        if after is None or r.low is not None and r.low > after:
            left -= r.n
            reach = r.high if reach is None else max(reach, r.high)
    return found


def page(spark: SparkSession, path: str, key: str, after, size: int, version: int | None = None) -> DataFrame:
    """The `size` rows that follow key `after`, by key; only files that can hold them are read. Keys must be unique and not null."""
    files = page_files(spark, path, after, size, version)
    rows = spark.read.parquet(*files) if files else read(spark, path, version).limit(0)
    if after is not None:
        rows = rows.where(F.col(f"`{key}`") > F.lit(after))
    return rows.orderBy(F.col(f"`{key}`")).limit(size)

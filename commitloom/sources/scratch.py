"""Intermediate tables in the folder that driver and executors share: lineage ends there, and a lost executor reruns nothing before it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local master may do without and gets a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="commitloom-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        path = "file://" + made
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(rows: DataFrame, label: str, instead_of: tuple[DataFrame, ...] = ()) -> DataFrame:
    """rows, written to the shared folder and read back. Shuffle files of what made them go.

    `instead_of` are written tables that nothing reads once this one is there; they are deleted.
    """
    spark = rows.sparkSession
    path = f"{folder(spark)}/commitloom/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(rows.schema).parquet(path)
    out._written_to = path
    for table in instead_of:
        old = spark._jvm.org.apache.hadoop.fs.Path(table.__dict__.pop("_written_to"))
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return out

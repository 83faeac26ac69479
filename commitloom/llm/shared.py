"""What the corpus operators share: the shared folder, cut lineage and text measures."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master may do without; it gets a temporary one."""
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


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/commitloom/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed meanwhile go when it ends: its result is written, so nothing reads them again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, label: str, block_mb: int = 128, instead_of: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and a lost executor costs no recomputation.

    `instead_of` are written tables that nothing reads once this one is there; they are deleted.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    with freed_shuffles(spark):
        df.write.option("parquet.block.size", block_mb << 20).option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    discard(*instead_of)
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that materialise() wrote; anything else, and what is gone already, is left alone."""
    for table in tables:
        path = None if table is None else table.__dict__.pop("_written_to", None)
        if path:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Rows of a few numbers that every executor can hold.
SMALL_ROWS = 100_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df, to be broadcast if it has no more than `rows` rows, by count; beyond that a join shuffles it. For written tables of numbers."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not use yet."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def groups(batches, keys: list[str]):
    """(key, pyarrow table) of every run of equal keys; rows must come sorted by them. One group is held at a time."""
    import pyarrow as pa

    held, current = [], None
    for batch in batches:
        rows = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for at in range(1, len(rows) + 1):
            if at < len(rows) and rows[at] == rows[start]:
                continue
            if held and rows[start] != current:
                yield current, pa.Table.from_batches(held).combine_chunks()
                held = []
            current = rows[start]
            held.append(batch.slice(start, at - start))
            start = at
    if held:
        yield current, pa.Table.from_batches(held).combine_chunks()


def matrix(column):
    """A list column whose lists are equally long, as float64 rows."""
    import numpy as np
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)

"""Incremental ingestion: raw commits arrive as files, each micro-batch is derived, scored and appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import derive, score

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def raw_stream(spark: SparkSession, path: str, columns: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(columns).option("maxFilesPerTrigger", files_per_trigger).json(path)


def large_state(spark: SparkSession) -> None:
    """Keep the keys seen so far in RocksDB on the executors' disks, in place of their heaps; call once for a session, before it streams."""
    spark.conf.set(PROVIDER, ROCKSDB)


def ingest(raw: DataFrame, out: str, checkpoint: str, key: str = "commit_hash") -> StreamingQuery:
    """Commits to `out`/commits and tags to `out`/tags, each commit once however many files, batches or restarts bring it.

    The keys seen are keyed streaming state, kept in the checkpoint: a commit of an earlier batch is dropped. A batch that is run again
    overwrites its own folder. Of rows of one key in one batch an arbitrary one is kept; rows without key are dropped.
    """

    def write(batch: DataFrame, number: int) -> None:
        commits, tags = f"{out}/commits/batch={number}", f"{out}/tags/batch={number}"
        derive.commit_rows(batch).write.mode("overwrite").parquet(commits)
        score.commit_tags(batch.sparkSession.read.parquet(commits)).write.mode("overwrite").parquet(tags)

    new = raw.where(F.col(key).isNotNull()).dropDuplicates([key])
    return new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Model calls that can be resumed: a ledger of replies by prompt, bounded concurrency, retries and time limits.

The ledger is a folder of Parquet files (prompt_key, reply, error), appended to round by round. A prompt whose reply it holds is never
asked again: not in a later run, not for another commit with the same prompt, and not when the job fails or loses an executor after the
round that asked it. What can be asked twice is bounded by the round: the prompts of one task that had not ended. Rounds are taken by
the prompt's hash, so they are the same on every run.

A call that fails or takes longer than `seconds` is tried `attempts` times; then its error is kept in the ledger and a later run asks again.
`ask` must be safe to call from `workers` threads of a task at once. A call that never returns keeps its thread until the task ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "prompt_key string, reply string, error string"


def replies(spark: SparkSession, ledger: str) -> DataFrame:
    """prompt_key and reply of every prompt that has one, once; empty if there is no ledger yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "prompt_key string, reply string")
    rows = spark.read.schema(SCHEMA).parquet(ledger)
    return rows.where("reply IS NOT NULL").groupBy("prompt_key").agg(F.min("reply").alias("reply"))


def _asked(ask: Callable[[str], str], attempts: int, seconds: float, workers: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        pool = ThreadPoolExecutor(workers)
        try:
            for batch in batches:
                for start in range(0, len(batch), workers):  # so many calls wait at once
                    part = batch.iloc[start : start + workers]
                    found: dict[str, str] = {}
                    errors: dict[str, str] = {}
                    for _ in range(attempts):
                        left = [(k, p) for k, p in zip(part["prompt_key"], part["prompt"], strict=True) if k not in found]
                        calls = [(k, pool.submit(ask, p)) for k, p in left]
                        for k, call in calls:
                            try:
                                reply = call.result(timeout=seconds)
                                if reply is None:
                                    raise ValueError("no reply")
                                found[k] = reply
                            except Exception as e:  # noqa: BLE001  kept as data
                                call.cancel()
                                errors[k] = f"{type(e).__name__}: {e}"
                        if len(found) == len(part):
                            break
                    keys = list(part["prompt_key"])
                    yield pd.DataFrame({"prompt_key": keys, "reply": [found.get(k) for k in keys], "error": [None if k in found else errors.get(k) for k in keys]}, dtype=object)
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    return run


def ask_all(rows: DataFrame, ask: Callable[[str], str], ledger: str, rounds: int = 16, tasks: int = 8, attempts: int = 3, seconds: float = 60, workers: int = 4) -> DataFrame:
    """rows (prompt, ...) with reply, null where no attempt had one. At most tasks * workers calls run at a time. Null prompts aren't asked."""
    spark = rows.sparkSession
    key = F.sha2(F.col("prompt"), 256)
    for k in range(rounds):
        turn = F.pmod(F.conv(F.substring("prompt_key", 1, 8), 16, 10).cast("long"), F.lit(rounds)) == k
        wanted = rows.where("prompt IS NOT NULL").select(key.alias("prompt_key"), "prompt").where(turn).dropDuplicates(["prompt_key"])
        new = wanted.join(replies(spark, ledger), "prompt_key", "left_anti").repartition(tasks, "prompt_key")
        new.mapInPandas(_asked(ask, attempts, seconds, workers), SCHEMA).write.mode("append").parquet(ledger)
    own = replies(spark, ledger).withColumnRenamed("reply", "_reply").withColumnRenamed("prompt_key", "_key")
    met = rows.withColumn("_own", key).join(own, F.col("_own") == F.col("_key"), "left")
    return met.select(*(F.col(f"`{c}`") for c in rows.columns if c != "reply"), F.col("_reply").alias("reply"))

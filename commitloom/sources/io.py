"""Readers and writers: JSON lines with bad lines kept, fan-out by subsystem, tables, resumption by keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import charset

# Table schemas.
COMMITS = (
    "commit_hash string, author_name string, author_email string, committer_name string, committer_email string, author_date timestamp, commit_date timestamp, subject string, body string, "
    "is_merge int, parent_count int, files_changed int, total_additions bigint, total_deletions bigint, fixes_hash string, signed_off_by array<string>, reviewed_by array<string>, acked_by array<string>, "
    "heuristic_score double, ai_quality_score double, quality_flags int, inserted_at timestamp, ai_score_reason string"
)
FILE_CHANGES = (
    "commit_hash string, file_path string, old_file_path string, change_type string, file_extension string, subsystem string, diff_hunk string, code_before string, code_after string, "
    "lines_added int, lines_deleted int, relevance_score double, is_binary int, inserted_at timestamp"
)
TAGS = "commit_hash string, flags int, tags array<string>"
CHAINS = "fix_commit string, buggy_commit string, fix_subject string, fix_body string, chain_type string"
AUTHORS = "author_email string, commit_count int, subsystems array<string>, first_commit timestamp, last_commit timestamp, expertise_score double, is_maintainer int"
TABLES = {"commits": COMMITS, "file_changes": FILE_CHANGES, "commit_tags": TAGS, "commit_chains": CHAINS, "author_expertise": AUTHORS}
EXAMPLE = "instruction string, input string, output string, _commit_hash string, _subsystem string, _lines_changed int"
BAD_LINE = "_corrupt_record"


def create_tables(spark: SparkSession, database: str | None = None) -> None:
    """All tables that don't exist yet, as zstd Parquet."""
    for name, columns in TABLES.items():
        full = f"{database}.{name}" if database else name
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet OPTIONS (compression 'zstd')")


def evolve(rows: DataFrame, columns: str) -> DataFrame:
    """rows with the columns of a schema: those that miss are null, new ones stay behind them."""
    wanted = T._parse_datatype_string(columns)
    known = {c.lower() for c in rows.columns}
    own = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name.lower() in known else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields]
    names = {f.name.lower() for f in wanted.fields}
    return rows.select(*own, *(F.col(f"`{c}`") for c in rows.columns if c.lower() not in names))


def append(rows: DataFrame, path: str, key: str | None = None, keys_expected: int | None = None) -> None:
    """Append by committed tasks; sorted within partitions by key, so that readers can skip row groups by its statistics.

    With `keys_expected`, the different keys of a row group, each row group gets a Bloom filter of its keys: a look-up by hash reads only
    those that may hold it, wherever the sort put it.
    """
    writer = (rows.sortWithinPartitions(key) if key else rows).write.mode("append").option("compression", "zstd")
    if key and keys_expected:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", keys_expected)
    writer.parquet(path)


def unseen(rows: DataFrame, done: DataFrame, key: str = "commit_hash") -> DataFrame:
    """Rows whose key was not written yet: resumption without offsets."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def resume_from(rows: DataFrame, ordinal: str, key: str, start: str) -> DataFrame:
    """Rows from the one with key `start` on, by their ordinal; all of them if it isn't there."""
    at = rows.where(F.col(key) == start).agg(F.min(ordinal).alias("_from"))
    return rows.crossJoin(F.broadcast(at)).where(F.col("_from").isNull() | (F.col(ordinal) >= F.col("_from"))).drop("_from")  # one row


def read_json_lines(spark: SparkSession, path: str, columns: str = EXAMPLE) -> DataFrame:
    """JSON lines of a schema; what is no JSON object is kept whole in _corrupt_record, blank lines are skipped."""
    fields = F.from_json("value", f"{columns}, {BAD_LINE} string", {"columnNameOfCorruptRecord": BAD_LINE, "mode": "PERMISSIVE"})
    rows = spark.read.text(path).where(F.trim(F.translate("value", "\t\r", "  ")) != "").select("value", fields.alias("row"))
    whole = F.col("row").isNull() | ~F.startswith(F.ltrim("value"), F.lit("{"))
    names = [f.name for f in T._parse_datatype_string(columns).fields]
    return rows.select(*(F.when(~whole, F.col(f"row.`{n}`")).alias(n) for n in names), F.when(whole, F.col("value")).otherwise(F.col(f"row.{BAD_LINE}")).alias(BAD_LINE))


def bad_lines(spark: SparkSession, path: str, columns: str = EXAMPLE) -> DataFrame:
    """The lines that read_json_lines keeps whole."""
    return read_json_lines(spark, path, columns).where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))


def missing_fields(spark: SparkSession, path: str, required: tuple[str, ...] = ("instruction", "output")) -> DataFrame:
    """number, line, fault: each line of a file that is no JSON object or lacks a field."""
    lines = numbered_lines(spark, path).where(F.trim("line") != "").select("number", "line", F.from_json("line", "map<string,string>").alias("fields"))
    fault = F.when(F.col("fields").isNull(), F.lit("Invalid JSON"))
    for f in required:
        fault = fault.when(~F.coalesce(F.map_contains_key("fields", f), F.lit(False)), F.lit(f"missing {f}"))
    return lines.select("number", "line", fault.alias("fault")).where("fault IS NOT NULL")


def write_json_lines(rows: DataFrame, path: str, files: int | None = None) -> None:
    """UTF-8 JSON lines; null fields are left out."""
    (rows.coalesce(files) if files else rows).write.mode("overwrite").json(path)


def write_by_subsystem(rows: DataFrame, path: str, column: str = "subsystem", limit: int | None = None, order: tuple[str, ...] = ()) -> None:
    """One folder for each subsystem in one pass, '/' written as '_'; rows are rebalanced, so a large subsystem gets many files.

    With a limit, the first `limit` rows of each subsystem by `order`; Spark drops the others before the shuffle.
    """
    if limit is not None:
        rows = rows.withColumn("_turn", F.row_number().over(Window.partitionBy(column).orderBy(*order))).where(F.col("_turn") <= limit).drop("_turn")
    named = rows.withColumn("_folder", F.replace(F.col(column), F.lit("/"), F.lit("_")))
    named.hint("rebalance", "_folder").write.mode("overwrite").partitionBy("_folder").json(path)


def with_synthetic(rows: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Bag union; fields of one side are null in the other."""
    return rows.unionByName(synthetic, allowMissingColumns=True)


def decoded(content: Column, limit: int = 100_000) -> Column:
    """Text of a blob, of which `limit` bytes are read: '' if one of the first 8000 is zero, UTF-8 if valid, else by its likely charset.

    A character that the limit cuts becomes U+FFFD and doesn't make the rest invalid. Only what is no UTF-8 leaves the JVM.
    """
    head = F.substring(content, 1, limit)
    zero = F.instr(F.hex(F.substring(head, 1, 8000)), "00") > 0
    zero = zero & F.hex(F.substring(head, 1, 8000)).rlike("^(?:..)*?00")
    # of a cut text, the start of a last character that lacks bytes
    tail = F.regexp_extract(F.hex(F.substring(head, -3, 3)), "((?:[CDEF].)|(?:[EF].[89AB].)|(?:F.[89AB].[89AB].))$", 1)
    spare = F.when(F.octet_length(content) > limit, F.length(tail) / 2).otherwise(0).cast("int")
    whole = head.substr(F.lit(1), F.octet_length(head) - spare)
    text = F.when(F.is_valid_utf8(head.cast("string")), head.cast("string")).when(F.is_valid_utf8(whole.cast("string")), F.concat(whole.cast("string"), F.when(spare > 0, "\ufffd").otherwise("")))
    return F.when(content.isNotNull(), F.when(zero, F.lit("")).otherwise(F.coalesce(text, charset.likely_text(F.when(~zero & text.isNull(), head)))))


def dry_run(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def history_union(*histories: DataFrame, grafts: DataFrame | None = None) -> DataFrame:
    """Several histories as one; grafts (commit_hash, parents) replace the parents of some commits."""
    rows = histories[0]
    for other in histories[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    rows = rows.dropDuplicates(["commit_hash"])
    if grafts is not None:
        new = grafts.select("commit_hash", F.col("parents").alias("_parents"))
        rows = rows.join(new, "commit_hash", "left").withColumn("parents", F.coalesce("_parents", "parents")).drop("_parents")
    return rows


def lookup(rows: DataFrame, value: str, key: str = "commit_hash") -> DataFrame:
    """The rows of one key: the filter reaches the scan."""
    return rows.where(F.col(key) == value)


def inspect(commits: DataFrame, files: DataFrame, order: list[str], n: int, peeks: dict[str, tuple[int, int]] | None = None, key: str = "commit_hash") -> DataFrame:
    """The first n rows of a join; of the columns in peeks only (head, tail) bytes are shown, with U+FFFD for a character that is cut."""
    rows = commits.join(files, key).orderBy(*order).limit(n)
    shown = []
    for c in rows.columns:
        if peeks and c in peeks:
            head, tail = peeks[c]
            raw = F.encode(F.col(f"`{c}`"), "UTF-8")
            last = raw.substr(F.greatest(F.octet_length(raw) - tail, F.lit(0)) + 1, F.lit(tail))
            shown += [F.make_valid_utf8(part.cast("string")).alias(f"{c}_{end}") for end, part in (("head", F.substring(raw, 1, head)), ("tail", last))]
        else:
            shown.append(F.col(f"`{c}`"))
    return rows.select(*shown)


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first n lines of one text file, in order."""
    return numbered_lines(spark, path).where(F.col("number") <= n)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """number (from 1) and line of one text file: counts of each part of the file, then an offset for each."""
    parts = spark.read.text(path).select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    counts = parts.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("from"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("from").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row for each part
    return parts.join(counts.select("part", "from", before.alias("before")), "part").select((F.col("at") - F.col("from") + F.col("before") + 1).alias("number"), "line")


def batches(rows: DataFrame, size: int = 10_000):
    """Rows in lists of `size`, partition after partition: the driver holds one partition at a time."""
    held = []
    for row in rows.toLocalIterator(prefetchPartitions=True):
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def counted(rows: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """rows with a count and a byte count that a write leaves in the observation, without a second pass."""
    seen = Observation(name)
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in rows.dtypes if t == "string"), F.lit(0))
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")), seen


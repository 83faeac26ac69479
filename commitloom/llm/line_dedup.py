r"""Line dedup by winnowing over line hashes (native).

Lines are trimmed and hashed; blank ones are never counted or deleted. A *unit* is the fewest consecutive lines from one on
that hold ``NOISE`` words, a *window* the fewest that hold ``SURE`` words, ahead from a line or back from it. Of the units that end
within a window ahead the one of least hash is a fingerprint. What a window selects depends on its lines alone, so two texts that
share a run of ``SURE`` words or more share a fingerprint.

Places of equal fingerprints are joined, and the documents of those that occur more than once go on. There matches are extended both
ways, window by window: a window ahead or back that equals one at an earlier place (by document id and line) repeats it, and the
windows of a repeated run reach from its first line (ahead) to its last (back) and over all between. So exactly the lines of runs of
``SURE`` words or more that occur earlier are deleted, by one grouping, however often a run repeats; places of a window are only
compared with the first of them, never with each other. A deleted line always has an equal line earlier on.

Hashes of lines, documents, units and windows have 128 bits. Only line numbers and hashes are shuffled until the end, when texts meet
the masks of those that change.

Defined cases: a null text stays null; an empty text stays empty; rows that agree in id and text are one document and share
the result; null ids come first in the order; texts of fewer than SURE words are left alone; empty input gives empty output;
other columns are kept and may have any name: the count of deleted lines is n_deleted, with underscores before it if that is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

NOISE = 40
SURE = 50
SEED = 90210


def _hash(*columns: Column | str) -> Column:
    """128 bits."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(SEED), *columns).alias("b"))


def _document(text: Column) -> Column:
    return _hash(F.col("doc_id"), text)


def line_table(docs: DataFrame) -> DataFrame:
    """doc (key of id and text), doc_id, pos, hash and words of every line."""
    text = F.col("text").cast("string")
    rows = docs.where(text.isNotNull()).select("doc_id", _document(text).alias("doc"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    return rows.select("doc_id", "doc", "pos", _hash(F.btrim("line", F.lit(" \t\r\x0b\x0c"))).alias("hash"), shared.n_words(F.col("line")).cast("int").alias("words"))


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with words, each once, numbered without the blank ones; start is the number of words before."""
    once = lines.where(F.col("words") > 0).repartition("doc").dropDuplicates(["doc", "pos"])
    order = Window.partitionBy("doc").orderBy("pos")
    return once.withColumn("ln", F.row_number().over(order)).withColumn("start", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def fingerprints(numbered: DataFrame, noise: int = NOISE, sure: int = SURE) -> DataFrame:
    """doc, doc_id, ln and unit of every selected unit."""
    ahead = Window.partitionBy("doc").orderBy("start")
    unit, window = ahead.rangeBetween(0, noise - 1), ahead.rangeBetween(0, sure - 1)
    rows = numbered.withColumn("held", F.sum("words").over(unit)).withColumn("unit", F.when(F.col("held") >= noise, _hash(F.collect_list("hash").over(unit))))
    rows = rows.withColumn("units", F.collect_list(F.when(F.col("unit").isNotNull(), F.struct("unit", "ln", (F.col("start") + F.col("held")).alias("until")))).over(window))
    rows = rows.withColumn("spans", F.sum("words").over(window)).where(F.col("spans") >= sure)
    least = F.array_min(F.filter("units", lambda u: u["until"] <= F.col("start") + F.col("spans")))
    return rows.select("doc_id", "doc", least.alias("least")).select("doc_id", "doc", "least.ln", "least.unit").distinct()


def windows(numbered: DataFrame, sure: int = SURE) -> DataFrame:
    """way (1 ahead, -1 back), key (of the lines), place (doc_id, doc, first) and last of every window."""
    ahead = Window.partitionBy("doc").orderBy("start").rangeBetween(0, sure - 1)
    back = Window.partitionBy("doc").orderBy("end").rangeBetween(-(sure - 1), 0)
    rows = numbered.withColumn("end", F.col("start") + F.col("words"))
    rows = rows.withColumn("ahead", F.when(F.sum("words").over(ahead) >= sure, F.struct(F.collect_list("hash").over(ahead).alias("lines"), F.col("ln").alias("first"), F.max("ln").over(ahead).alias("last"))))
    rows = rows.withColumn("back", F.when(F.sum("words").over(back) >= sure, F.struct(F.collect_list("hash").over(back).alias("lines"), F.min("ln").over(back).alias("first"), F.col("ln").alias("last"))))
    both = F.array(*(F.struct(F.lit(way).alias("way"), _hash(f"{name}.lines").alias("key"), F.col(f"{name}.first").alias("first"), F.col(f"{name}.last").alias("last")) for way, name in ((1, "ahead"), (-1, "back"))))
    rows = rows.where("ahead IS NOT NULL OR back IS NOT NULL").select("doc_id", "doc", F.explode(both).alias("w")).where("w.first IS NOT NULL")
    return rows.select("w.way", "w.key", F.struct("doc_id", "doc", "w.first").alias("place"), "w.last")


def repeated_lines(docs: DataFrame, noise: int = NOISE, sure: int = SURE) -> tuple[DataFrame, DataFrame]:
    """The line table, and (doc, pos) of the lines to delete; both written."""
    lines = shared.materialise(line_table(docs), "lines")
    numbered = shared.materialise(_numbered(lines), "numbered-lines")
    prints = shared.materialise(fingerprints(numbered, noise, sure).select("doc", "unit"), "fingerprints")
    often = prints.groupBy("unit").agg(F.count("*").alias("n")).where("n > 1").select("unit")
    used = shared.materialise(prints.join(often, "unit").select("doc").distinct(), "matched-documents", instead_of=(prints,))
    every = shared.materialise(windows(numbered.join(used, "doc"), sure), "line-windows")
    first = every.groupBy("way", "key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = every.join(first, ["way", "key"]).where(F.col("place") != F.col("first"))
    later = later.select("place.doc", F.explode(F.sequence("place.first", "last")).alias("ln")).distinct()
    gone = numbered.select("doc", "ln", "pos").join(later, ["doc", "ln"]).select("doc", "pos")
    return lines, shared.materialise(gone, "repeated-lines", instead_of=(every, used, numbered))


def without_repeats(docs: DataFrame, noise: int = NOISE, sure: int = SURE) -> DataFrame:
    """docs with later repeated runs deleted from text, and the number of lines deleted as `count_name` calls it."""
    lines, gone = repeated_lines(docs, noise, sure)
    masks = lines.select("doc", "pos").join(gone.select("doc").distinct(), "doc").distinct().join(gone.withColumn("gone", F.lit(True)), ["doc", "pos"], "left")
    masks = masks.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("gone").isNull().alias("stays")))).alias("mask"))
    key, mask = shared.free_name(docs, "_doc"), shared.free_name(docs, "_mask")
    masks = shared.materialise(masks.select(F.col("doc").alias(key), F.col("mask.stays").alias(mask)), "line-masks", instead_of=(lines, gone))
    text = F.col("text").cast("string")
    kept = F.filter(F.arrays_zip(F.split(text, "\n", -1).alias("line"), F.col(mask).alias("stays")), lambda x: x["stays"])
    shorter = F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
    joined = docs.withColumn(key, _document(text)).join(masks.hint("shuffle_hash"), key, "left")
    columns = [F.when(F.col(mask).isNull(), text).otherwise(shorter).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    deleted = F.coalesce(F.size(F.filter(F.col(mask), lambda x: ~x)), F.lit(0)).cast("long")
    return joined.select(*columns, F.when(F.col(mask).isNull(), F.lit(0).cast("long")).otherwise(deleted).alias(count_name(docs)))


def count_name(docs: DataFrame) -> str:
    return shared.free_name(docs, "n_deleted")

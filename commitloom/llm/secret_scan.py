r"""Secret scans over an incremental blob ledger (native).

Every version of every path is content-addressed (SHA-256 of its bytes). The ledger holds which (blob, rule version) pairs
were scanned and what they held, so a new rule version or a new commit scans only unseen pairs; findings are joined back to
every path that holds the blob. A span keeps the version of the rule that found it: what a replaced version found stays in the
ledger and is left out of the result.

The scanned text of a blob is taken from one representative row, found by a join on (blob, path): both sides are spread by
both keys, so a blob that a third of all rows share is no hot key. Texts are searched once; what was found is written without
them. Spans come from the gaps between matches (``split``) and the matches (``regexp_extract_all``): a running sum of both
lengths gives code-point offsets.

Defined cases: a null text is the empty blob and has no findings; null ids are paths like any other; repeated rows are one blob
and each get its findings; empty input gives empty output; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared


@dataclass(frozen=True)
class Rule:
    """`pattern` finds leftmost non-overlapping candidates; one counts if its `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed patterns. A run that is too short holds no longer run, so for access and hex the length is part of the pattern.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
_SPAN = "struct<start:bigint,rule:string,end:bigint>"


def content_addressed(versions: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """path, blob and text of every version."""
    body = shared.text_or_empty(F.col(text))
    return versions.select(F.col(path).alias("path"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("blob"), body.alias("text"))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rules, spans) for the unseen (blob, rule version) pairs of content-addressed versions."""
    blobs = versions.groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*(F.lit(r.key) for r in rules))
    if ledger is None:
        todo = blobs.withColumn("rules", every)
    else:
        seen = ledger.select("blob", F.explode("rules").alias("rule")).distinct()
        todo = blobs.withColumn("rule", F.explode(every)).join(seen, ["blob", "rule"], "left_anti")
        todo = todo.groupBy("blob", "path").agg(F.sort_array(F.collect_set("rule")).alias("rules"))
    v, t = versions.alias("v"), todo.hint("shuffle_hash").alias("t")
    texts = v.join(t, F.col("v.blob").eqNullSafe(F.col("t.blob")) & F.col("v.path").eqNullSafe(F.col("t.path")))
    texts = texts.select("t.blob", "t.rules", "v.text")
    found = F.filter(F.array(*map(_candidates, rules)), lambda c: F.size(c["hits"]) > 0)
    # Rows that agree in blob and path bring one blob several times; what was found in it is the same.
    searched = shared.materialise(texts.select("blob", "rules", found.alias("found")), "searched-blobs")
    # Blobs with findings are few, so only they are spread out; the rest of the ledger row is known already.
    none = searched.where(F.size("found") == 0).select("blob", "rules").dropDuplicates(["blob"]).withColumn("spans", F.from_json(F.lit("[]"), f"array<{_SPAN}>"))
    hits = searched.where(F.size("found") > 0).dropDuplicates(["blob"]).select("blob", "rules", F.inline("found"))
    hits = hits.select("blob", "rules", "rule", F.posexplode("hits").alias("at", "hit"))
    order = Window.partitionBy("blob", "rule").orderBy("at")
    upto = F.sum(F.col("hit.gap") + F.col("hit.length")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = hits.withColumn("end", upto).withColumn("start", F.col("end") - F.col("hit.length"))
    spans = spans.groupBy("blob").agg(
        F.first("rules").alias("rules"),
        F.sort_array(F.collect_list(F.when(F.col("hit.counts"), F.struct("start", "rule", "end")))).alias("spans"),
    )
    return none.unionByName(spans)


def _candidates(rule: Rule):
    gaps = F.transform(F.split(F.col("text"), rule.pattern, -1), lambda x: F.length(x).cast("bigint"))
    whole = F.regexp_extract_all(F.col("text"), F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(F.col("text"), F.lit(rule.pattern), F.lit(rule.group))
    hits = F.zip_with(
        F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))),
        F.arrays_zip(whole.alias("w"), part.alias("p")),
        lambda g, m: F.struct(g.alias("gap"), F.length(m["w"]).cast("bigint").alias("length"), (F.length(m["p"]) >= rule.least).alias("counts")),
    )
    due = F.array_contains("rules", rule.key) & F.col("text").rlike(rule.pattern)
    empty = F.from_json(F.lit("[]"), "array<struct<gap:bigint,length:bigint,counts:boolean>>")
    return F.struct(F.lit(rule.key).alias("rule"), F.when(due, hits).otherwise(empty).alias("hits"))


def _named(span, rules: tuple[Rule, ...]):
    """A ledger's span by start, place of its rule among the current ones (null for a replaced version), kind and end."""
    rank, kind = F.lit(None).cast("int"), F.lit(None).cast("string")
    for k, r in enumerate(rules):
        rank, kind = F.when(span["rule"] == r.key, F.lit(k)).otherwise(rank), F.when(span["rule"] == r.key, F.lit(r.kind)).otherwise(kind)
    return F.struct(span["start"].alias("start"), rank.alias("rank"), kind.alias("kind"), span["end"].alias("end"))


def digest(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans, comma-joined."""
    kept = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_documents(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of every row of docs. The ledger under `ledger_path` is read if it is there, and gets the new scans appended."""
    spark = docs.sparkSession
    versions = content_addressed(docs)
    ledger = None
    if ledger_path:
        from pyspark.errors import AnalysisException

        try:
            ledger = spark.read.parquet(ledger_path)
        except AnalysisException:
            ledger = None
    path = ledger_path or shared.new_path(spark, "blob-ledger")
    scan(versions, ledger, rules).write.mode("append").parquet(path)
    found = spark.read.schema(f"blob binary, rules array<string>, spans array<{_SPAN}>").parquet(path).where(F.size("spans") > 0)
    if ledger is not None:  # a blob's rules may have been scanned at different times
        found = found.select("blob", F.explode("spans").alias("s")).groupBy("blob").agg(F.collect_set("s").alias("spans"))
    found = found.select("blob", F.array_sort(F.filter(F.transform("spans", lambda s: _named(s, rules)), lambda s: s["rank"].isNotNull())).alias("spans"))
    rows = versions.select("path", "blob").join(found.select("blob", "spans"), "blob", "left")
    spans = F.coalesce(F.col("spans"), F.from_json(F.lit("[]"), "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"))
    counts = [F.size(F.filter(F.transform(spans, lambda s: s["kind"]), F.lit(r.kind).__eq__)).cast("long").alias(f"n_{r.kind}") for r in rules]
    return rows.select(
        F.col("path").alias("doc_id"),
        *counts,
        F.sha2(digest(spans, tuple(r.kind for r in RULES)).cast("binary"), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
    )

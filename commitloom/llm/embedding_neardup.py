"""Embedding near-duplicates by NN-descent.

Only vectors of equal label and length are compared. Equal vectors form classes and one of each goes on.

Start: every vector falls into one leaf of each of ``TABLES`` sign-of-projection tables, with so many bits that a leaf holds
about ``LEAF`` vectors; larger leaves are dealt into parts. Each vector's ``K`` best in its leaves are its first neighbours.

Descent: in each round a vector's neighbours and the vectors it is a neighbour of are joined with each other, if one of the
pair is new; better ones enter the lists, until few do. Threshold edges of the lists then give components.

Saturation: a list whose last entry still passes the threshold may hide more. Two vectors whose link no list shows both have
such full lists, so these vectors get a second list, of the best in other components, by the same start and descent; links
found there merge components, and this goes on until no second list holds one. Links within a component are never rows: all
its vectors meet block against block, and only counts per vector leave a task. Large components are cut into blocks that
meet two at a time.

Audit: ``AUDIT`` vectors, by a fixed hash, are compared with all rows; the share of their links that lie within a component is
the recall. It only measures: below ``RECALL`` the start and the descent go on from the lists with fresh tables, and after
``ATTEMPTS`` of them the run fails.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, rows without a label or id link with
nothing; repeated rows count as vectors of their own; ties in cosine go to the smaller id; empty input gives empty output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph, shared

THRESHOLD = 0.93
K = 8
TABLES = 8
BITS = 24
LEAF = 256
LEAF_MOST = 1024
ROUNDS = 6
SETTLED = 0.002
BLOCK = 2048
AUDIT = 1024
RECALL = 0.95
ATTEMPTS = 12
SEED = 1234577


def usable(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow on the way to the norm
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _leaves(nodes: DataFrame, seed: int) -> DataFrame:
    """The nodes once for each table, with leaf and part."""
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("bits", F.greatest(F.lit(0), F.least(F.lit(BITS), F.ceil(F.log2(F.col("n") / LEAF)))).cast("int"))
    rows = nodes.join(sizes.drop("n"), ["label", "dim"])

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims, bits = batch.column("dim").to_numpy(), batch.column("bits").to_numpy()
            codes = np.zeros((len(dims), TABLES), np.int64)
            vectors = batch.column("vector")
            for dim in np.unique(dims).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, TABLES * BITS))
                at = np.flatnonzero(dims == dim)
                side = (shared.matrix(vectors.take(pa.array(at))) @ planes[dim] > 0).reshape(len(at), TABLES, BITS)
                used = np.arange(BITS) < bits[at][:, None]
                codes[at] = ((side & used[:, None, :]) << np.arange(BITS)).sum(axis=2)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(dims) * TABLES + 1, TABLES, dtype=np.int32)), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "label", "dim", "vector")), lists], ["node", "label", "dim", "vector", "codes"])

    kinds = dict(nodes.dtypes)
    coded = rows.select("node", "label", "dim", "vector", "bits").mapInArrow(signs, f"node {kinds['node']}, label {kinds['label']}, dim int, vector {kinds['vector']}, codes array<long>")
    coded = coded.select("node", "label", "dim", "vector", F.posexplode("codes").alias("table", "leaf"))
    key = ["label", "dim", "table", "leaf"]
    heavy = coded.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > LEAF_MOST)
    coded = coded.join(heavy, key, "left")
    return coded.withColumn("part", F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / LEAF_MOST))).otherwise(F.lit(0)).cast("int"))


def _best(ids: np.ndarray, vectors: np.ndarray, out: list, apart: np.ndarray | None = None) -> None:
    """The K best of each of the vectors among the others, or among those of other components (`apart`)."""
    if len(ids) < 2:
        return
    unit = _unit(vectors)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2)
    if apart is not None:
        sims[apart[:, None] == apart[None, :]] = -2
    k = min(K, len(ids) - 1)
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(sims, top, 1).ravel()
    real = best > -2
    if real.any():
        out.append((np.repeat(ids, k)[real], ids[top].ravel()[real], best[real]))


def _edges(out: list, kind: pa.DataType) -> pa.RecordBatch:
    columns = [np.concatenate([o[c] for o in out]) for c in range(3)]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], kind), pa.array(columns[2], pa.float64())], ["node", "other", "sim"])


def start(nodes: DataFrame, seed: int, components: DataFrame | None = None) -> DataFrame:
    """node, other, sim: neighbours within leaves, only those of other components if these are given."""
    kind, parted = dict(nodes.dtypes)["node"], components is not None

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        for _, rows in shared.groups(batches, ["label", "dim", "table", "leaf", "part"]):
            apart = rows.column("component").to_numpy() if parted else None
            _best(rows.column("node").to_numpy(), shared.matrix(rows.column("vector")), out, apart)
            if len(out) >= 64:
                yield _edges(out, rows.schema.field("node").type)
                out.clear()
        if out:
            yield _edges(out, rows.schema.field("node").type)

    key = ["label", "dim", "table", "leaf", "part"]
    leaves = _leaves(nodes, seed).select("node", "vector", *key)
    if parted:
        leaves = leaves.join(components, "node")
    return leaves.repartition(*key).sortWithinPartitions(*key).mapInArrow(near, f"node {kind}, other {kind}, sim double")


def _top(edges: DataFrame) -> DataFrame:
    """The K best different neighbours of every node; round is when each came."""
    once = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("round").alias("round"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))
    return once.withColumn("rank", rank).where(F.col("rank") <= K).drop("rank")


def _around(lists: DataFrame, fresh: Column) -> DataFrame:
    """The 2 * K first neighbours of every node either way."""
    around = lists.select("node", "other", "sim", fresh.alias("new")).unionByName(lists.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim", fresh.alias("new")))
    around = around.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.max("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("new"), F.desc("sim"), "other"))
    return around.withColumn("rank", rank).where(F.col("rank") <= 2 * K)


def _join_neighbours(lists: DataFrame, nodes: DataFrame, turn: int, ties: DataFrame | None = None, components: DataFrame | None = None) -> DataFrame:
    """Better neighbours among neighbours of neighbours; a pair is compared if one of the two came in the last round.

    With components, `lists` hold neighbours of other components, `ties` those of any, and only pairs of two components count.
    """
    kind, parted = dict(nodes.dtypes)["node"], components is not None
    around = _around(lists, F.col("round") == turn - 1)
    if ties is not None:
        around = around.unionByName(_around(ties, F.lit(False))).groupBy("node", "other").agg(F.max("new").alias("new"))
    worst = lists.groupBy("node").agg(F.min("sim").alias("worst"), F.count("*").alias("n"))
    members = nodes.select(F.col("node").alias("other"), "vector").join(worst.select(F.col("node").alias("other"), F.when(F.col("n") >= K, F.col("worst")).alias("worst")), "other", "left")
    members = members.withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
    if parted:
        members = members.join(components.withColumnRenamed("node", "other"), "other")
    around = around.select("node", "other", "new").join(members, "other")  # other, node, new, vector, worst, component

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        for _, rows in shared.groups(batches, ["node"]):
            new = rows.column("new").to_numpy(zero_copy_only=False)
            if len(new) < 2 or not new.any():
                continue
            ids, worst = rows.column("other").to_numpy(), rows.column("worst").to_numpy()
            unit = _unit(shared.matrix(rows.column("vector")))
            sims = unit @ unit.T
            np.fill_diagonal(sims, -3)
            if parted:
                apart = rows.column("component").to_numpy()
                sims[apart[:, None] == apart[None, :]] = -3
            i, j = np.nonzero((new[:, None] | new[None, :]) & (sims > worst[:, None]))
            if len(i):
                out.append((ids[i], ids[j], sims[i, j]))
            if len(out) >= 256:
                yield _edges(out, rows.schema.field("other").type)
                out.clear()
        if out:
            yield _edges(out, rows.schema.field("other").type)

    found = around.repartition("node").sortWithinPartitions("node").mapInArrow(met, f"node {kind}, other {kind}, sim double")
    return found.groupBy("node", "other").agg(F.max("sim").alias("sim"))


def descend(nodes: DataFrame, first: DataFrame, ties: DataFrame | None = None, components: DataFrame | None = None) -> DataFrame:
    """Neighbour lists from `first` on, refined until few entries change; ties and components as in _join_neighbours."""
    lists = shared.materialise(_top(first.withColumn("round", F.lit(0))), "neighbours")
    for turn in range(1, ROUNDS + 1):
        found = _join_neighbours(lists, nodes, turn, ties, components).withColumn("round", F.lit(turn))
        lists = shared.materialise(_top(lists.unionByName(found)), "neighbours", instead_of=(lists,))
        r = lists.agg(F.count("*").alias("n"), F.count_if(F.col("round") == turn).alias("new")).first()
        if r["new"] <= SETTLED * r["n"]:
            break
    return lists


def _linked(nodes: DataFrame, lists: DataFrame, links: DataFrame, threshold: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """links and their components, with the links between components that full lists hide."""
    full = lists.groupBy("node").agg(F.count("*").alias("n"), F.min("sim").alias("least")).where((F.col("n") >= K) & (F.col("least") >= threshold))
    full = shared.materialise(nodes.join(full.select("node"), "node"), "saturated")
    while True:
        components = shared.materialise(graph.connected_components(links), "vector-components")
        apart = full.join(components, "node")
        several = apart.groupBy("label", "dim").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("label", "dim")
        apart = shared.materialise(apart.join(several, ["label", "dim"]), "saturated-apart")
        if apart.isEmpty():
            return links, components
        seed += 1
        some, its = apart.drop("component"), apart.select("node", "component")
        found = descend(some, start(some, seed, its), lists, its).where(F.col("sim") >= threshold)
        found = shared.materialise(found.select(F.col("node").alias("u"), F.col("other").alias("v")), "bridges")
        if found.isEmpty():
            return links, components
        links = shared.materialise(links.unionByName(found).distinct(), "threshold-edges")


def _audit(nodes: DataFrame, threshold: float) -> DataFrame:
    """u, v: all links of AUDIT nodes, compared with every row of their label."""
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(AUDIT).collect()  # AUDIT vectors
    queries: dict = {}
    for r in chosen:
        queries.setdefault((r["label"], r["dim"]), []).append((r["node"], r["vector"]))
    sent = nodes.sparkSession.sparkContext.broadcast({k: (np.asarray([i for i, _ in v]), _unit(np.asarray([x for _, x in v], np.float64))) for k, v in queries.items()})
    kind = dict(nodes.dtypes)["node"]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True))
            for key in set(keys) & sent.value.keys():
                at = np.flatnonzero([k == key for k in keys])
                ids, unit = batch.column("node").to_numpy(zero_copy_only=False)[at], _unit(shared.matrix(batch.column("vector").take(pa.array(at))))
                q, vectors = sent.value[key]
                sims = vectors @ unit.T
                i, j = np.nonzero((sims >= threshold) & (q[:, None] != ids[None, :]))
                if len(i):
                    t = batch.schema.field("node").type
                    yield pa.RecordBatch.from_arrays([pa.array(q[i], t), pa.array(ids[j], t)], ["u", "v"])

    return nodes.mapInArrow(searched, f"u {kind}, v {kind}")


def _counts(nodes: DataFrame, components: DataFrame, threshold: float) -> DataFrame:
    """node, links: vectors within its component that pass the threshold, by blocks."""
    kind = dict(nodes.dtypes)["node"]
    parts = components.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    rows = nodes.join(components, "node").join(parts, "component")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("node", "copies", "vector", "component", "part", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), group in shared.groups(batches, ["component", "i", "j"]):
            part = group.column("part").to_numpy()
            ids, copies, unit = group.column("node").to_numpy(), group.column("copies").to_numpy(), _unit(shared.matrix(group.column("vector")))
            a, b = np.flatnonzero(part == i), np.flatnonzero(part == j)
            linked = unit[a] @ unit[b].T >= threshold
            if i == j:
                np.fill_diagonal(linked, False)
                at, links = a, linked @ copies[b]
            else:
                at, links = np.concatenate((a, b)), np.concatenate((linked @ copies[b], copies[a] @ linked))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at], group.schema.field("node").type), pa.array(links.astype(np.int64))], ["node", "links"])

    key = ["component", "i", "j"]
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(counted, f"node {kind}, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept and audit_recall of every row of vectors (vec_id, embedding, label)."""
    vector, label = F.col("embedding"), F.col("label")
    rows = vectors.select("vec_id", label, vector, (usable(label, vector) & F.col("vec_id").isNotNull()).alias("usable"))
    keys = ["label", "dim", "h1", "h2"]
    marked = rows.where("usable").select("vec_id", "label", F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(SEED), "embedding").alias("h2"), F.col("embedding").alias("vector"))
    classes = marked.groupBy(*keys).agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    classes = shared.materialise(classes, "vector-classes")
    nodes = marked.select("vec_id", "label", "dim", "h1", "h2", "vector").withColumnRenamed("vec_id", "node").join(classes, [*keys, "node"]).dropDuplicates(["node", *keys])
    nodes = shared.materialise(nodes.select("node", "label", "dim", "copies", "vector"), "vector-nodes")
    audit = shared.materialise(_audit(nodes, threshold), "audit")
    lists, links, recall, attempt = None, None, 0.0, 0
    while not attempt or recall < RECALL:
        if attempt == ATTEMPTS:
            raise RuntimeError(f"recall {recall:.4f} after {ATTEMPTS} attempts, {RECALL} wanted")
        first = start(nodes, SEED + 1000 * attempt)
        lists = descend(nodes, first if lists is None else first.unionByName(lists.select("node", "other", "sim")))
        found = lists.where(F.col("sim") >= threshold).select(F.col("node").alias("u"), F.col("other").alias("v"))
        links = shared.materialise(found if links is None else links.unionByName(found).distinct(), "threshold-edges")
        links, components = _linked(nodes, lists, links, threshold, SEED + 1000 * attempt)
        recall = _recall(audit, components)
        attempt += 1
    counts = _counts(nodes, components, threshold)
    named = classes.join(components, "node", "left").join(counts, "node", "left")
    named = named.select(*(F.col(c).alias(f"_{c}") for c in keys), F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    at = [F.col(c) == F.col(f"_{c}") for c in keys]
    done = marked.drop("vector").join(named, at).select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    done = done.unionByName(alone)
    return done.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))).withColumn("audit_recall", F.lit(recall))


def _recall(audit: DataFrame, components: DataFrame) -> float:
    """Share of the audited links whose ends share a component; its own links are never added."""
    c = components.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    d = components.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    r = audit.join(c, "u", "left").join(d, "v", "left").agg(F.count("*").alias("n"), F.count_if(F.col("cu") == F.col("cv")).alias("hit")).first()
    return r["hit"] / r["n"] if r["n"] else 1.0

r"""Exact n-gram Jaccard join by prefix trees.

A document's set holds the 64-bit hashes of its distinct word n-grams. Equal sets form classes, and only one of each class
goes on. The join of the rest has two parts:

*Routing.* Two sets with Jaccard >= t differ in at most H = (1 - t) / (1 + t) * (|a| + |b|) elements. With the hash range cut
into m > H equal ranges, at least m - H ranges hold the same elements in both, so the sums of the elements' hashes by range are
marks of which a linked pair shares that many. m is a power of two, and a set emits the marks of every m that a partner of its
could need. All sets order marks alike, from those of few sets to those of many, empty ranges last; then the least mark that a
pair shares is among the first H + 1 of either, and the others are dropped: passages that many documents share route nothing.
A pair could share empty ranges alone only if both fill no more than H, so a set goes on to larger m until it fills more; no
link is lost. Sets that share a mark (each with the smallest, never pairwise) span coarse components: near copies and little
else.

*Joining.* The sets of a coarse component are ordered by their n-grams' frequency there, most frequent first, and stored in a
path-compressed trie. A set's traversal carries the overlap so far down shared paths, and leaves a subtree as soon as the
overlap plus what remains of either side can't reach the bound, or when all its sets are in the same component already. Large
coarse components are cut into blocks, so a task's memory is bounded; what no block has brought together meets in further
blocks, and all links are joined by connected components.

Defined cases: null text, and text without words, has an empty set and links with nothing; fewer words than n make one n-gram;
equal texts, repeated rows and ties are one class, whose component is its smallest id; rows with a null id have a null
component unless their class has an id; ids are taken to be unique (two texts under one id may share a component); empty
input gives empty output; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import graph, shared

BLOCK_SETS = 1024
BLOCK_TOKENS = 4_000_000
SLICES = 8
SLICED = [f"marks_{k}" for k in range(SLICES)]
HELD = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    h = h + np.uint64(salt)
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Sorted distinct 64-bit n-gram hashes of texts; A-Z count as a-z, words are runs of other than ASCII white space."""

    def __init__(self, n: int):
        self.n = n
        self.table = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD) | np.uint64(1)
        self.space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        self._grow(1 << 14)

    def _grow(self, size: int) -> None:
        self.up = np.cumprod(np.full(size, _ODD, np.uint64))
        self.down = np.cumprod(np.full(size, np.uint64(pow(int(_ODD), -1, 1 << 64)), np.uint64))

    def words(self, text: str) -> np.ndarray:
        """A 64-bit hash of every word: a polynomial over its bytes, from running sums over the whole text."""
        data = np.frombuffer(text.encode().lower(), np.uint8)  # bytes.lower() touches A-Z only
        if len(data) > len(self.up):
            self._grow(2 * len(data))
        space = self.space[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.table[data] * self.up[: len(data)])))
        return _mixed((sums[end] - sums[start]) * self.down[start]) if len(start) else np.zeros(0, np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        words = self.words(text or "")
        if not len(words):
            return words
        width = min(self.n, len(words))
        hashes = np.full(len(words) - width + 1, np.uint64(width))
        for k in range(width):
            hashes = hashes * _ODD + words[k : len(words) - width + 1 + k]
        return np.unique(_mixed(hashes))


def most_differing(total: int, percent: int) -> int:
    """Elements in which two sets of `total` elements in all may differ at a Jaccard of percent / 100."""
    return total * (100 - percent) // (100 + percent)


def least_overlap(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def signatures(tokens: np.ndarray, percent: int) -> tuple[list[np.ndarray], list[int]]:
    """Marks of the ranges that hold something, by level, and how many of a level's marks may go unused."""
    n = len(tokens)
    if not n:
        return [], []
    low = most_differing(n + -(-percent * n // 100), percent)
    high = most_differing(n + 100 * n // percent, percent)
    hashes, marks, spares = _mixed(tokens, 0x51ED270B), [], []
    bits, filled = low.bit_length(), 0  # 2 ** bits > H
    while bits <= high.bit_length() or filled <= high:
        part = (tokens >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(n, np.int64)
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        filled = len(starts)
        marks.append(_mixed(np.add.reduceat(hashes, starts) * _ODD + part[starts].astype(np.uint64), bits + 1).view(np.int64))
        spares.append(max(0, filled - high - 1))
        bits += 1
    return marks, spares


class _Node:
    __slots__ = ("children", "longest", "member", "mixed", "rest", "sets", "shortest", "tokens")

    def __init__(self, tokens: list[int], size: int, rest: int, member: int):
        self.tokens = tokens
        self.children: dict[int, _Node] = {}
        self.sets: list[int] = []
        self.shortest = self.longest = size
        self.rest = rest  # most tokens below this node's own
        self.member, self.mixed = member, False


class TrieJoin:
    """Sets of one block, joined through a trie of their tokens in one order; links between sets of one component are skipped."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, -counts))] = np.arange(len(values))
        self.sets = [np.sort(rank[np.searchsorted(values, s)]).tolist() for s in sets]
        self.parent = list(range(len(sets)))
        self.root = _Node([], 0, 0, -1)
        self.root.shortest, self.root.longest = 1 << 62, 0

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def insert(self, k: int) -> None:
        tokens, node, at = self.sets[k], self.root, 0
        size = len(tokens)
        while True:
            node.shortest, node.longest = min(node.shortest, size), max(node.longest, size)
            node.rest = max(node.rest, size - at)
            node.mixed = node.mixed or node.member < 0 or self.find(node.member) != self.find(k)
            if node.member < 0:
                node.member, node.mixed = k, False
            if at == size:
                node.sets.append(k)
                return
            child = node.children.get(tokens[at])
            if child is None:
                child = node.children[tokens[at]] = _Node(tokens[at:], size, 0, k)
                child.sets.append(k)
                return
            same = 0
            for a, b in zip(child.tokens, tokens[at:], strict=False):
                if a != b:
                    break
                same += 1
            if same < len(child.tokens):  # split the path where the sets part
                upper = _Node(child.tokens[:same], child.shortest, 0, child.member)
                upper.longest, upper.mixed = child.longest, child.mixed
                upper.rest = child.rest + len(child.tokens) - same
                child.tokens = child.tokens[same:]
                upper.children[child.tokens[0]] = child
                node.children[tokens[at]] = child = upper
            node, at = child, at + same

    def probe(self, k: int) -> None:
        """Unite set k with every component in the trie that holds a set it links with."""
        query, tokens = set(self.sets[k]), self.sets[k]
        size, percent = len(tokens), self.percent
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if not node.mixed and (node.member < 0 or self.find(node.member) == self.find(k)):
                continue
            if 100 * node.longest < percent * size or 100 * size < percent * node.shortest:
                continue
            path = node.tokens
            if path:
                overlap += len(query.intersection(path))
                left = size - bisect_right(tokens, path[-1])
            else:
                left = size
            # Any partner below has at least max(shortest, percent of size) elements.
            need = least_overlap(size, max(node.shortest, -(-percent * size // 100)), percent)
            if overlap + min(left, node.rest) < need:
                continue
            for other in node.sets:
                if overlap >= least_overlap(size, len(self.sets[other]), percent):
                    self.union(k, other)
            stack.extend((child, overlap) for child in node.children.values())

    def join(self, first: int | None = None) -> list[int]:
        """Roots of the components: all sets against all, or the sets from `first` on against those before."""
        n = len(self.sets)
        if first is None:
            for k in sorted(range(n), key=lambda i: len(self.sets[i])):
                self.probe(k)
                self.insert(k)
        else:
            for k in range(first):
                self.insert(k)
            for k in range(first, n):
                self.probe(k)
        return [self.find(k) for k in range(n)]


def _ends(lists: list) -> pa.Array:
    return pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())


def shingle_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, size and two sums that stand for the set, and its signatures: column marks_k holds, by level, the marks of slice k."""
    if percent <= 50:
        raise ValueError("sets that differ in more than they share can't be routed: percent must be over 50")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = [shingler.shingles(t) for t in batch.column("text").to_pylist()]
                sums = [[int(_mixed(s, salt).sum().view(np.int64)) if len(s) else 0 for s in sets] for salt in (1, 2)]
                found = [signatures(s, percent) for s in sets]
                levels = [m for marks, _ in found for m in marks]
                flat = np.concatenate(levels) if levels else np.zeros(0, np.int64)
                level, part, ends = np.repeat(np.arange(len(levels)), [len(m) for m in levels]), flat % SLICES, _ends([marks for marks, _ in found])
                marks = []
                for k in range(SLICES):
                    here = part == k
                    counts = np.concatenate(([0], np.bincount(level[here], minlength=len(levels))))
                    by_level = pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.array(flat[here], pa.int64()))
                    marks.append(pa.ListArray.from_arrays(ends, by_level))
                spares = pa.array([spares for _, spares in found], pa.list_(pa.int32()))
                columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(s, pa.int64()) for s in sums), spares, *marks]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "h1", "h2", "spares", *SLICED])

    of_slices = ", ".join(f"{c} array<array<long>>" for c in SLICED)
    return rows.mapInArrow(made, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles long, h1 long, h2 long, spares array<int>, {of_slices}")


def _joined(docs: DataFrame, blocks: DataFrame, n: int, percent: int) -> DataFrame:
    """u, v: links that span the components of every block (group, i, j) of blocks (node, h1, side).

    Sets of side 0 are joined with each other if a block has no others, else with those of side 1. Texts are shuffled, not sets:
    they are shorter and compress, and a task holds the sets of one block at a time. Up to `HELD` rows, blocks are broadcast, so that
    only their own texts are shuffled.
    """
    node = blocks.schema["node"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("node"), F.col("text").cast("string").alias("text"))
    blocks = blocks.select("node", "h1", "side", "group", "i", "j")
    held_here = shared.small_side(blocks, HELD)
    rows = rows.join(blocks.hint("shuffle_hash") if held_here is blocks else held_here, "node")
    rows = rows.select("node", "h1", "side", "group", "i", "j", "text")

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        with np.errstate(over="ignore"):
            held, key, us, vs, kind = [], None, [], [], None
            for batch in batches:
                kind = batch.column("node").type
                groups = list(zip(*(batch.column(c).to_pylist() for c in ("group", "i", "j")), strict=True))
                sides, ids, sums = (batch.column(c).to_pylist() for c in ("side", "node", "h1"))
                for group, side, name, h, text in zip(groups, sides, ids, sums, batch.column("text"), strict=True):
                    if group != key:
                        _links(held, percent, us, vs)
                        held, key = [], group
                    tokens = shingler.shingles(text.as_py())
                    if len(tokens) and int(_mixed(tokens, 1).sum().view(np.int64)) == h:  # else another text of the same id
                        held.append((side, name, tokens))
                if us:
                    yield pa.RecordBatch.from_arrays([pa.array(us, kind), pa.array(vs, kind)], ["u", "v"])
                    us, vs = [], []
            _links(held, percent, us, vs)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, kind), pa.array(vs, kind)], ["u", "v"])

    return rows.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j").mapInArrow(done, f"u {node}, v {node}")


def _links(held: list, percent: int, us: list, vs: list) -> None:
    if len(held) < 2:
        return
    held.sort(key=lambda h: h[0])
    first = sum(h[0] == 0 for h in held)
    if not first:
        return
    for k, root in enumerate(TrieJoin([h[2] for h in held], percent).join(None if first == len(held) else first)):
        if root != k and held[k][1] != held[root][1]:
            us.append(held[k][1])
            vs.append(held[root][1])


def similar_groups(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs."""
    wide = shared.materialise(shingle_sets(docs, n, percent), "shingles")
    same = ["n_shingles", "h1", "h2"]
    sets = shared.materialise(wide.drop("spares", *SLICED), "shingle-sums")
    classes = shared.materialise(sets.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("node")).where("node IS NOT NULL"), "shingle-classes")
    coarse = graph.connected_components(_shared_marks(wide, classes))
    labels = _labels(docs, classes, coarse, n, percent)
    shared.discard(coarse)
    named = classes.join(labels, "node", "left").select(*(F.col(c).alias(f"_{c}") for c in same), F.coalesce("component", "node").alias("component"))
    at = [sets[c] == F.col(f"_{c}") for c in same]
    done = sets.join(named, at, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return shared.materialise(done, "shingle-groups", instead_of=(sets, classes, labels))


def _shared_marks(wide: DataFrame, classes: DataFrame) -> DataFrame:
    """u, v: classes that share one of their rarest marks with the least class that has it. Deletes `wide`.

    Marks are random numbers and several times the texts, so all of them are on disk once only. One slice after the other is met with the
    classes, to leave copies out, and leaves its arrays twice, to be counted and to be met by the counts of those that more sets than one
    have. The files of one slice are gone before the next one's, and only marks that sets share are kept.
    """
    same = (wide["doc_id"] == classes["node"]) & (wide["h1"] == classes["h1"]) & (wide["h2"] == classes["h2"])
    slices = []
    for c in SLICED:
        held = shared.materialise(wide.join(classes, same, "left_semi").select(F.col("doc_id").alias("node"), "spares", F.col(c).alias("marks")), "class-marks")
        # A mark of one set alone brings nothing together, and comes first in the order.
        often = held.select(F.explode(F.flatten("marks")).alias("mark")).groupBy("mark").agg(F.count("*").alias("sets")).where(F.col("sets") > 1)
        often = shared.materialise(often, "frequent-marks")
        marks = held.select("node", "spares", F.posexplode("marks").alias("level", "found"))
        marks = marks.select("node", F.struct("level", F.get("spares", "level").alias("spare")).alias("level"), F.explode("found").alias("mark"))
        slices.append(shared.materialise(marks.join(often.hint("shuffle_hash"), "mark"), "met-marks", instead_of=(often, held)))
    shared.discard(wide)
    met = reduce(DataFrame.unionByName, slices)
    fall = Window.partitionBy("node", "level").orderBy(F.desc("sets"), F.desc("mark"))
    rare = met.withColumn("turn", F.row_number().over(fall)).where(F.col("turn") > F.col("level.spare"))
    rare = shared.materialise(rare.select("node", "mark"), "rare-marks", instead_of=tuple(slices))
    shares = rare.groupBy("mark").agg(F.min("node").alias("least"), F.max("node").alias("most")).where(F.col("least") < F.col("most"))
    edges = rare.join(shares.select("mark", "least").hint("shuffle_hash"), "mark").where(F.col("node") != F.col("least"))
    return shared.materialise(edges.select(F.col("node").alias("u"), F.col("least").alias("v")).distinct(), "coarse-edges", instead_of=(rare,))


def _parts() -> F.Column:
    return F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_TOKENS)).cast("int")


def _part(parts: F.Column) -> F.Column:
    return F.pmod(F.xxhash64("node"), parts).cast("int")


def _blocks(sized: DataFrame) -> DataFrame:
    """Each set in one block of its group."""
    rows = sized.join(sized.groupBy("group").agg(_parts().alias("parts")), "group")
    return rows.withColumn("side", F.lit(0)).withColumn("i", _part(F.col("parts"))).withColumn("j", F.lit(0))


def _labels(docs: DataFrame, classes: DataFrame, coarse: DataFrame, n: int, percent: int) -> DataFrame:
    """node, component of the classes that link with another.

    A coarse component that fits a block is joined there. A larger one is dealt to blocks, each joined by itself; then one set
    of each component found is joined with the others'. What is still apart from the largest component meets every set of its
    coarse component in blocks of two sides. So each set is read about once where near copies fall together, and no link is lost.
    """
    sized = classes.select("node", "n_shingles", "h1").join(coarse, "node").withColumnRenamed("component", "group")
    blocks = shared.materialise(_blocks(sized), "coarse")
    links = shared.materialise(_joined(docs, blocks, n, percent), "shingle-links")
    large = shared.materialise(blocks.where("parts > 1").select("node", "n_shingles", "h1", "group", "parts"), "large-coarse", instead_of=(blocks,))
    found = graph.connected_components(links)
    if large.isEmpty():
        shared.discard(links, large)
        return found
    heads = large.join(found, "node", "left").where(F.coalesce("component", "node") == F.col("node")).drop("component", "parts")
    heads = shared.materialise(_blocks(heads), "heads", instead_of=(found,))
    nearer = shared.materialise(_joined(docs, heads, n, percent), "head-links", instead_of=(heads,))
    found = graph.connected_components(links.unionByName(nearer))
    large = shared.materialise(large.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "large", instead_of=(large,))
    counts = large.groupBy("group", "component").agg(F.count("*").alias("sets"))
    most = counts.groupBy("group").agg(F.max(F.struct("sets", "component"))["component"].alias("most"))
    apart = large.join(most, "group").where(F.col("component") != F.col("most"))
    pieces = apart.groupBy("group").agg(_parts().alias("pieces"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = apart.join(pieces, "group").select("node", "h1", F.lit(0).alias("side"), "group", _part(F.col("pieces")).alias("i"), every("parts").alias("j"))
    right = large.join(pieces, "group").select("node", "h1", F.lit(1).alias("side"), "group", _part(F.col("parts")).alias("j"), every("pieces").alias("i"))
    crossed = shared.materialise(left.unionByName(right), "crossed", instead_of=(large,))
    if crossed.isEmpty():
        shared.discard(links, nearer, crossed)
        return found
    last = shared.materialise(_joined(docs, crossed, n, percent), "crossed-links", instead_of=(found, crossed))
    whole = graph.connected_components(links.unionByName(nearer).unionByName(last))
    shared.discard(links, nearer, last)
    return whole

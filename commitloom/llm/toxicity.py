r"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Learning: a bounded sample of labelled rows (``EXAMPLES``, by a fixed hash) gives document counts of words, word beginnings and
beginnings that ``REPEATS`` or more different words of a text share; those whose signed G-squared against the label passes a bound that lets about ``FALSE_TERMS`` pass by chance span the vector space (``TERMS`` at most). Inverse
document frequencies of these terms are counted over all documents. The examples' vectors form a block-max inverted index:
postings by term and block of ``BLOCK`` examples, with the largest weight of each term in each block.

Scoring: a text's blocks are visited by falling upper bound (its weights times the blocks' maxima) until no bound can beat the
k-th best cosine, so the k nearest are exact. Their votes weigh by cosine and are smoothed towards the base rate; a text
without any term scores the examples' own rate among such texts. The nearest examples are returned as evidence.

Defined cases: null text counts as empty; empty texts score the rate of texts without terms; without labelled rows every score
is 0; repeated rows score alike; conflicting labels of an id count as toxic; ties in cosine go to the lower example number;
null labels are no examples; other columns are kept out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from . import shared

EXAMPLES = 16_384
TERMS = 4096
BLOCK = 64
FIRST_BLOCKS = 4
NEIGHBOURS = 15
LEAST_DOCS = 3
PREFIXES = (3, 4, 5, 6, 7, 8)
REPEATS = (2, 3)
FALSE_TERMS = 1.0
SMOOTHING = 1.0
THRESHOLD = 0.7
CACHE = 300_000
VOTES = 50_000
_WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word, *(f"^{word[:n]}" for n in PREFIXES if len(word) > n)]


def all_terms(text: str) -> list[str]:
    """Every term of a text, repeated beginnings among them."""
    words = Counter(t for w in set(_WORD.findall(text.lower())) for t in terms_of(w))
    return [*words, *(f"{t}*{k}" for t, n in words.items() for k in REPEATS if n >= k)]


def held_out(doc_id) -> F.Column:
    """Rows of the fold that labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def examples(labels: DataFrame, bound: int = EXAMPLES) -> DataFrame:
    """doc_id and toxic of a bounded sample of the rows that may be learned from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents and toxic documents of every term."""
    counts: dict[str, list[int]] = {}

    def flushed() -> pa.RecordBatch:
        columns = [pa.array(list(counts)), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["term", "n", "n_toxic"])

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for term in all_terms(text):
                c = counts.setdefault(term, [0, 0])
                c[0] += 1
                c[1] += toxic
        if len(counts) > 4 * CACHE:
            yield flushed()
            counts.clear()
    if counts:
        yield flushed()


def select_terms(texts: DataFrame) -> list[str]:
    """Terms of the examples (text, toxic) that go with the label beyond chance, TERMS at most."""
    totals = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    if not totals["p"] or totals["p"] == totals["n"]:
        return []
    counts = texts.mapInArrow(_term_counts, "term string, n long, n_toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("a"))
    counts = shared.materialise(counts.where(F.col("a") >= LEAST_DOCS), "toxic-terms")
    tested = max(1, counts.count())
    n, a = F.col("n").cast("double"), F.col("a").cast("double")
    total, toxic = float(totals["n"]), float(totals["p"])
    clean, b = total - toxic, n - a

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    g = 2 * (part(a, n * toxic / total) + part(b, n * clean / total) + part(toxic - a, (total - n) * toxic / total) + part(clean - b, (total - n) * clean / total))
    kept = counts.withColumn("g", g).where((F.col("g") >= 2 * math.log(tested / FALSE_TERMS)) & (a / toxic > 3 * b / clean))
    terms = [r["term"] for r in kept.orderBy(F.desc("g"), "term").limit(TERMS).collect()]
    shared.discard(counts)
    return terms


class TermFinder:
    """Numbers and frequencies of the terms in a text; words seen before cost one lookup, in a map of CACHE words at most."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        plain = dict.fromkeys(t.partition("*")[0] for t in terms)
        self.index = {t: i for i, t in enumerate(plain)}
        self.levels = [[(k, self.number[name]) for k, name in ((1, t), *((k, f"{t}*{k}") for k in REPEATS)) if name in self.number] for t in plain]
        self.cache: dict[str, tuple[int, ...]] = {}

    def find(self, text: str) -> tuple[list[int], list[int]]:
        words: Counter = Counter()
        uses: Counter = Counter()
        for word, n in Counter(_WORD.findall(text.lower())).items():
            hits = self.cache.get(word)
            if hits is None:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                hits = self.cache[word] = tuple(self.index[t] for t in terms_of(word) if t in self.index)
            for h in hits:
                words[h] += 1
                uses[h] += n
        found = sorted((number, uses[h] if k == 1 else 1) for h, n in words.items() for k, number in self.levels[h] if n >= k)
        return [f[0] for f in found], [f[1] for f in found]


def features(docs: DataFrame, terms: list[str], keep: list[str], names: tuple[str, str]) -> DataFrame:
    """The columns `keep` of every row, with the term numbers and term frequencies of its text under two other names."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)  # TERMS at most

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = TermFinder(sent.value)
        for batch in batches:
            pairs = [finder.find(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array([p[k] for p in pairs], pa.list_(pa.int32())) for k in (0, 1))], [*keep, *names])

    rows = docs.select(*dict.fromkeys([*(f"`{c}`" for c in keep), "`text`"]))
    schema = StructType([*(docs.schema[c] for c in keep), *(StructField(n, ArrayType(IntegerType())) for n in names)])
    return rows.mapInArrow(found, schema)


def unit(terms, tf, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TF-IDF vector of length one."""
    at = np.asarray(terms, np.int64)
    w = (1 + np.log(np.asarray(tf, np.float64))) * idf[at]
    return at, w / np.sqrt((w * w).sum())


@dataclass
class BlockMaxIndex:
    """Example vectors by term and block, with block maxima; exact k nearest by cosine.

    Postings lie by block, then term: those of a term in a block are ``at`` and ``weight`` from ``start[slot]`` to
    ``start[slot + 1]``, where ``slot`` is -1 for a term that the block lacks.
    """

    ids: np.ndarray
    toxic: np.ndarray
    maxima: np.ndarray  # term by block: largest weight
    slot: np.ndarray  # block by term
    start: np.ndarray
    at: np.ndarray
    weight: np.ndarray

    @classmethod
    def build(cls, ids: list[int], toxic: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> BlockMaxIndex:
        # Examples that share their heaviest term sit in the same blocks, which keeps block maxima tight.
        order = sorted(range(len(ids)), key=lambda i: (int(vectors[i][0][vectors[i][1].argmax()]), ids[i]))
        blocks = -(-len(ids) // BLOCK)
        place = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        term, weight = (np.concatenate([vectors[i][c] for i in order]) for c in (0, 1))
        key = place // BLOCK * n_terms + term
        by_key = np.argsort(key, kind="stable")
        key, place, weight = key[by_key], place[by_key], weight[by_key]
        known, start = np.unique(key, return_index=True)
        slot = np.full(blocks * n_terms, -1, np.int32)
        slot[known] = np.arange(len(known))
        maxima = np.zeros(blocks * n_terms)
        maxima[known] = np.maximum.reduceat(weight, start)
        return cls(
            np.asarray([ids[i] for i in order]),
            np.asarray([toxic[i] for i in order], np.float64),
            np.ascontiguousarray(maxima.reshape(blocks, n_terms).T),
            slot.reshape(blocks, n_terms),
            np.append(start, len(key)),
            place % BLOCK,
            weight,
        )

    def scores(self, blocks: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Cosines with the examples of some blocks: a row for each block."""
        slots = self.slot[blocks[:, None], terms]
        row, column = np.nonzero(slots >= 0)
        found = slots[row, column]
        first, n = self.start[found], self.start[found + 1] - self.start[found]
        posting = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        products = self.weight[posting] * np.repeat(weights[column], n)
        return np.bincount(np.repeat(row * BLOCK, n) + self.at[posting], products, len(blocks) * BLOCK).reshape(len(blocks), BLOCK)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """(cosine, place) of the k nearest examples with a cosine over 0, best first.

        Blocks are visited by falling bound, ever more at a time, until no bound reaches the k-th best cosine.
        """
        bounds = weights @ self.maxima[terms]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        cosines, places, visited, step = np.zeros(0), np.zeros(0, np.int64), 0, FIRST_BLOCKS
        while visited < len(order):
            blocks = order[visited : visited + step]
            if len(cosines) == k:
                blocks = blocks[bounds[blocks] * (1 + 1e-12) >= cosines[-1]]
                if not len(blocks):
                    break
            scores = self.scores(blocks, terms, weights)
            row, at = np.nonzero(scores >= cosines[-1] if len(cosines) == k else scores)
            cosines, places = np.concatenate((cosines, scores[row, at])), np.concatenate((places, blocks[row] * BLOCK + at))
            best = np.lexsort((places, -cosines))[:k]
            cosines, places = cosines[best], places[best]
            visited, step = visited + step, 4 * step
        return list(zip(cosines.tolist(), places.tolist(), strict=True))


@dataclass
class Model:
    terms: list[str]
    idf: np.ndarray
    index: BlockMaxIndex | None
    base: float
    blank: float

    def vote_cached(self, terms, tf, known: dict) -> tuple[float, list[tuple[int, float]]]:
        """As vote(); texts with equal terms, such as copies, are looked up in `known`, which holds VOTES entries at most."""
        key = (*terms, *tf)
        done = known.get(key)
        if done is None:
            done = self.vote(terms, tf)
            if len(key) <= 128:
                if len(known) >= VOTES:
                    known.clear()
                known[key] = done
        return done

    def vote(self, terms, tf) -> tuple[float, list[tuple[int, float]]]:
        """Score and the nearest examples."""
        if self.index is None or not len(terms):
            return self.blank, []
        near = self.index.nearest(*unit(terms, tf, self.idf))
        weight = sum(c for c, _ in near)
        votes = sum(c * self.index.toxic[p] for c, p in near)
        return float((votes + SMOOTHING * self.base) / (weight + SMOOTHING)), [(int(self.index.ids[p]), c) for c, p in near[:3]]


def fit(docs: DataFrame, labels: DataFrame, bound: int = EXAMPLES, keep: list[str] | None = None, names: tuple[str, str] = ("terms", "tf")) -> tuple[Model, DataFrame]:
    """The model and, written, the features of all rows of docs with their columns `keep` (doc_id alone by default)."""
    sample = shared.materialise(examples(labels, bound).coalesce(1), "toxic-examples")  # `bound` rows at most
    known = docs.select("doc_id", shared.text_or_empty(F.col("text")).alias("text")).join(F.broadcast(sample), "doc_id")
    terms = select_terms(known)
    written = shared.materialise(features(docs, terms, keep or ["doc_id"], names), "toxic-features")
    found = written.select("doc_id", *(F.col(f"`{n}`").alias(c) for n, c in zip(names, ("terms", "tf"), strict=True)))
    idf = np.zeros(len(terms))
    n = found.count()
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # TERMS rows at most
        idf[r["t"]] = math.log((n + 1) / (r["count"] + 0.5))
    shown = found.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    rates = {r["some"]: (r["n"], r["toxic"]) for r in shown.groupBy((F.size("terms") > 0).alias("some")).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()}
    every = sum(v[0] for v in rates.values())
    base = sum(v[1] for v in rates.values()) / every if every else 0.0
    blank = (rates[False][1] + base) / (rates[False][0] + 1) if False in rates else base
    rows = shown.where(F.size("terms") > 0).orderBy("doc_id").collect()  # `bound` rows at most
    index = BlockMaxIndex.build([r["doc_id"] for r in rows], [r["toxic"] for r in rows], [unit(r["terms"], r["tf"], idf) for r in rows], len(terms)) if rows else None
    return Model(terms, idf, index, base, blank), written


def score(found: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row of features."""
    sent = found.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = sent.value, {}
        for batch in batches:
            done = [m.vote_cached(t, tf, known) for t, tf in zip(batch.column("terms").to_pylist(), batch.column("tf").to_pylist(), strict=True)]
            evidence = [",".join(f"{i}:{c:.4f}" for i, c in d[1]) for d in done]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([d[0] for d in done], pa.float64()), pa.array(evidence, pa.string())], ["doc_id", "score", "evidence"])

    rows = found.mapInArrow(scored, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, score double, evidence string")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model, found = fit(docs, labels)
    return score(found, model)


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic: all columns, each row judged by its own text.

    The features are written beside the rows, so that no text is searched twice and ids need not be unique.
    """
    names = (shared.free_name(docs, "terms"), shared.free_name(docs, "tf"))
    model, written = fit(docs, labels, keep=docs.columns, names=names)
    sent, columns = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = sent.value, {}
        for batch in batches:
            pairs = zip(*(batch.column(n).to_pylist() for n in names), strict=True)
            keep = [m.vote_cached(terms, tf, known)[0] < THRESHOLD for terms, tf in pairs]
            yield batch.select(columns).filter(pa.array(keep, pa.bool_()))

    return written.mapInArrow(kept, docs.schema)

r"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of more than ``CHUNK`` code points is cut into chunks that each run ``OVERLAP`` code points into the next; chunks are
spread over the cluster and pre-tokenised in parallel. A match of the pattern depends only on what follows its start, so once
two chunks share a pre-token boundary in their overlap they agree from there on: the first shared one is where the later
chunk takes over. Only boundaries behind a non-space character count, since there the look-ahead ``\s+(?!\S)`` of the pattern
can't reach across. Chunks between which nothing resynchronises become one piece, which is pre-tokenised again from where it
starts; its end is compared with the next chunk, and so on until every cut resynchronises. So a piece is about as long as a
chunk or as its longest pre-token. A chunk is encoded where it is pre-tokenised, with the number of ids up to each boundary in its
overlaps: once the cuts are known, a piece of one chunk is a slice of the ids it has, and only pieces of several chunks are
encoded again. Decoding concatenates the raw bytes of the ids, once a text's ids are together, so only ids are shuffled.

The chunk table is written to the shared folder in small row groups: rows keep their key if an executor is lost, and any
task can read a part of a text, so the cut itself needs no shuffle. Boundaries are stitched without texts and ids.

Defined cases: null text counts as empty (no ids, no bytes); repeated rows each get their ids; ids of any type and null ids
pass through; empty input gives empty output; other columns are ignored. A run of white space, letters or digits of any length
is matched outside the library, whose pattern engine overflows its stack on a million, and merged as one pre-token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import accumulate, takewhile

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

CHUNK = 16_384
OVERLAP = 256
LONG = 2 * CHUNK


def _codec(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _finder(pattern: str):
    import regex

    return regex.compile(pattern).finditer


def _ids(codec, text: str, find) -> bytes:
    """Ids as little-endian unsigned 32-bit integers; `find` is the pattern's finditer."""
    import numpy as np

    if len(text) <= LONG:
        ids = codec.encode_ordinary(text)
    else:
        ids = [i for m in find(text) for i in codec._encode_single_piece(m.group().encode())]
    return np.asarray(ids, "<u4").tobytes()


def _decoded(codec, ids: bytes) -> bytes:
    import numpy as np

    return codec.decode_bytes(np.frombuffer(ids, "<u4").tolist())


def boundaries(text: str, find) -> list[int]:
    """Starts of pre-tokens behind a non-space character, up to the last match, which the cut may have shortened."""
    return [m.start() for m in find(text) if m.start() and not text[m.start() - 1].isspace()]


def _tokenised(parts: DataFrame, ranks, find_pattern: str, chunk: int, overlap: int) -> DataFrame:
    """key, part, parts, ids, and the boundaries in both overlaps (head, tail) with the ids before each (head_n, tail_n); written.

    Boundaries count from the start of their overlap: head from the chunk's own start, tail from that of the next chunk.
    """

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, find = _codec(ranks.value, find_pattern), _finder(find_pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py()
                marks = boundaries(text, find)
                head, tail = list(takewhile(lambda b: b <= overlap, marks)), [b for b in marks if b >= chunk]
                cuts = sorted({0, *head, *tail, len(text)})
                ids = [_ids(codec, text[a:b], find) for a, b in zip(cuts, cuts[1:], strict=False)]
                before = dict(zip(cuts, accumulate((len(i) // 4 for i in ids), initial=0), strict=True))
                rows.append((b"".join(ids), head, [before[b] for b in head], [b - chunk for b in tail], [before[b] for b in tail]))
            ids, *lists = zip(*rows, strict=True) if rows else ([], [], [], [], [])
            columns = [*(batch.column(c) for c in ("key", "part", "parts")), pa.array(ids, pa.binary()), *(pa.array(x, pa.list_(pa.int32())) for x in lists)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "part", "parts", "ids", "head", "head_n", "tail", "tail_n"])

    made = parts.mapInArrow(tokenised, "key long, part int, parts int, ids binary, head array<int>, head_n array<int>, tail array<int>, tail_n array<int>")
    return shared.materialise(made, "bpe-ids")


def _stitched(parts: DataFrame, coded: DataFrame, find_pattern: str, chunk: int) -> DataFrame:
    """key, first and last (chunks), since and until (where in the text) of every piece, and low and high, the ids of a single chunk that are its own; written."""

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Boundaries of joined chunks from the start of the next chunk on."""
        find = _finder(find_pattern)
        for batch in batches:
            tails = []
            for first, last, since, texts in zip(*(batch.column(c).to_pylist() for c in ("first", "last", "since", "texts")), strict=True):
                text = _whole(texts, chunk)[since - first * chunk :]
                behind = (last + 1) * chunk - since
                tails.append([b - behind for b in boundaries(text, find) if b >= behind])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("first"), pa.array(tails, pa.list_(pa.int32()))], ["key", "first", "tail"])

    order = Window.partitionBy("key").orderBy("first")
    at = lambda marks, counts, place: F.get(counts, (F.array_position(marks, place) - 1).cast("int"))
    pieces = coded.select("key", F.col("part").alias("first"), F.col("part").alias("last"), "parts", "head", "head_n", "tail", "tail_n")
    columns, done = ["key", "first", "last", "since", "until", "low", "high"], None
    while True:
        cut = pieces.withColumn("stop", F.array_min(F.array_intersect("tail", F.lead("head").over(order)))).withColumn("begin", F.lag("stop").over(order))
        since = F.coalesce(F.col("first").cast("long") * chunk + F.col("begin"), F.lit(0).cast("long"))
        cut = cut.withColumn("since", since).withColumn("until", (F.col("last") + 1).cast("long") * chunk + F.col("stop")).withColumn("broken", F.col("stop").isNull() & (F.col("last") < F.col("parts") - 1))
        cut = cut.withColumn("low", F.coalesce(at("head", "head_n", F.col("begin")), F.lit(0))).withColumn("high", at("tail", "tail_n", F.col("stop")))
        cut = shared.materialise(cut, "bpe-cuts", instead_of=(pieces,))
        bad = shared.materialise(cut.where("broken").select("key").distinct(), "bpe-broken")
        if bad.isEmpty():
            return cut.select(*columns) if done is None else done.unionByName(cut.select(*columns))
        few = shared.small_side(bad)  # only texts with a broken cut go on
        whole = cut.join(few, "key", "left_anti").select(*columns)
        done = whole if done is None else done.unionByName(whole)
        cut = cut.join(few, "key", "left_semi")
        run = F.sum(F.when(F.coalesce(F.lag("broken").over(order), F.lit(False)), 0).otherwise(1)).over(order)
        joined = cut.withColumn("run", run).groupBy("key", "run").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.first("parts").alias("parts"), *(F.min_by(c, "first").alias(c) for c in ("head", "head_n", "since")), *(F.max_by(c, "first").alias(c) for c in ("tail", "tail_n")), F.count("*").alias("n")
        )
        joined = shared.materialise(joined, "bpe-joined")
        wide = joined.where("n > 1").select("key", "first", "last", "since", F.explode(F.sequence("first", "last")).alias("part"))
        texts = parts.join(shared.small_side(wide), ["key", "part"]).groupBy("key", "first").agg(F.first("last").alias("last"), F.first("since").alias("since"), F.sort_array(F.collect_list(F.struct("part", "text"))).alias("texts"))
        tails = texts.mapInArrow(again, "key long, first int, tail array<int>").withColumnRenamed("tail", "anew")
        # what is before a boundary of several chunks isn't counted: these are encoded again in the end
        anew = joined.join(tails, ["key", "first"], "left").select("key", "first", "last", "parts", "head", "head_n", F.coalesce("anew", "tail").alias("tail"), F.when(F.col("anew").isNull(), F.col("tail_n")).alias("tail_n"))
        pieces = shared.materialise(anew, "bpe-marks", instead_of=(joined,))


def _whole(texts: list[dict], chunk: int) -> str:
    """Consecutive chunks as one text."""
    return "".join([*(t["text"][:chunk] for t in texts[:-1]), texts[-1]["text"]])


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded (binary) of every row."""
    with open(ranks_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    rows = docs.select("doc_id", shared.text_or_empty(F.col("text")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, find = _codec(sent.value, pattern), _finder(pattern)
        for batch in batches:
            ids = [_ids(codec, t, find) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([_decoded(codec, i) for i in ids], pa.binary())], ["doc_id", "ids", "decoded"])

    long = F.length("text") > chunk
    short = rows.where(~long).mapInArrow(whole, f"doc_id {kind}, ids binary, decoded binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc, text in zip(*(batch.column(c) for c in ("key", "doc_id", "text")), strict=True):
                t = text.as_py()
                n = -(-len(t) // chunk)
                parts = [t[i * chunk : (i + 1) * chunk + overlap] for i in range(n)]
                columns = [pa.array([key.as_py()] * n, pa.int64()), pa.array([doc.as_py()] * n, batch.schema.field("doc_id").type), pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32()), pa.array(parts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "part", "parts", "text"])

    keyed = rows.where(long).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    parts = keyed.mapInArrow(cut, f"key long, doc_id {kind}, part int, parts int, text string")
    parts = shared.materialise(parts, "bpe-chunks", block_mb=4)

    marked = _tokenised(parts, sent, pattern, chunk, overlap)
    pieces = _stitched(parts, marked, pattern, chunk)
    spread = pieces.where("first < last").select("key", "first", "since", "until", F.explode(F.sequence("first", "last")).alias("part"))
    wide = parts.join(shared.small_side(spread), ["key", "part"]).groupBy("key", "first").agg(F.first("since").alias("since"), F.first("until").alias("until"), F.sort_array(F.collect_list(F.struct("part", "text"))).alias("texts"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, find = _codec(sent.value, pattern), _finder(pattern)
        for batch in batches:
            done = []
            for since, until, texts in zip(*(batch.column(c).to_pylist() for c in ("since", "until", "texts")), strict=True):
                at = texts[0]["part"] * chunk
                text = _whole(texts, chunk)
                done.append(_ids(codec, text[since - at : None if until is None else until - at], find))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("first"), pa.array(done, pa.binary())], ["key", "first", "own"])

    again = shared.materialise(wide.mapInArrow(coded, "key long, first int, own binary"), "bpe-wide")
    cuts = pieces.where("first = last").select("key", F.col("first").alias("part"), "low", "high", F.lit(None).cast("binary").alias("own"))
    cuts = cuts.unionByName(again.select("key", F.col("first").alias("part"), F.lit(0).alias("low"), F.lit(None).cast("int").alias("high"), "own"))
    plans = cuts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("part", "low", "high", "own"))).alias("cuts"))
    ordered = marked.select("key", "part", "ids").groupBy("key").agg(F.collect_list(F.struct("part", "ids")).alias("all"))
    names = parts.where("part = 0").select("key", "doc_id")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, pattern)
        for batch in batches:
            for doc, every, cuts in zip(*(batch.column(c) for c in ("doc_id", "all", "cuts")), strict=True):
                own = {x["part"]: x["ids"] for x in every.as_py()}
                ids = b"".join([own[c["part"]][4 * c["low"] : None if c["high"] is None else 4 * c["high"]] if c["own"] is None else c["own"] for c in cuts.as_py()])
                columns = [pa.array([doc.as_py()], batch.schema.field("doc_id").type), pa.array([ids], pa.binary()), pa.array([_decoded(codec, ids)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    joined = ordered.join(plans.hint("shuffle_hash"), "key").join(names.hint("shuffle_hash"), "key").select("doc_id", "all", "cuts")
    return short.unionByName(joined.mapInArrow(decoded, f"doc_id {kind}, ids binary, decoded binary"))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids and decoded bytes."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

r"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

Texts are encoded once and cut into pieces of at most `limit` tokens, which are written. How often each length occurs, at most
`limit` numbers however large the corpus, is all that the driver sees. Over this histogram it solves the configuration linear
program: the fewest sequences, each filled after one *configuration* (how many pieces of which length), that hold all pieces.

* Multiplicative weights: a length weighs its tokens times exp(-rate x the share of its pieces that is placed), so what lags behind
  gets dearer.
* Pricing: a knapsack dynamic program over the capacity finds the configuration of largest weight among ``DRAWN`` lengths, half of
  them those that lag most and half drawn at random, each at most as often as pieces are left.
* Rounding: a step uses its configuration until its scarcest length advances by a set share, rounded down to whole sequences, at
  least one. So no piece is placed twice, the solution is integral and the last steps fill what is left as well as it can be.

Each step takes a share of some length, so there are at most a few for each length (about ``STEPS``), whatever their counts; fewer
lengths get finer steps. ``RATES`` of learning are tried until one comes within ``CLOSE`` of the lower bound on sequences;
the best result stays. Slow learning suits corpora with many short pieces, fast learning those in which large pieces compete for
small ones.

The plan says which ranks within a length go to which sequence and offset; its size is bounded like the steps, and it is broadcast.
Ranks are counted on the cluster, by length and salt, so that a length that a third of all pieces share is split; each piece finds
its place by a binary search.

White space separates tokens in vocabularies with word ends: a text is split at blanks and known words are looked up in a map of
at most ``CACHE`` entries. Of a new word of letters and signs the library's model gets the two parts; any other goes through
the whole library. `separable` says whether a tokenizer allows this; else texts go in whole.

Defined cases: null text counts as empty and is one piece that holds the end token; repeated rows and ids are separate documents;
null ids and ids of any type pass through; other columns are ignored; empty input gives empty output.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .token_count import byte_symbols

LIMIT = 4096
RATES = (0.05, 1.0, 8.0)
CLOSE = 0.001
STEPS = 8192
DRAWN = 64
SEED = 4096
CACHE = 400_000
KNOWN = 64
STRETCH = 1 << 20
FLUSH = 1 << 21
SALTED = 50_000
#: Letters of which neither composition nor the vocabulary's bytes need a look around, then signs but for the apostrophe.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def separable(spec: dict) -> bool:
    """Whether ids of a text are those of its blank-separated parts, and runs of letters and of signs in them are pre-tokens."""
    before, cut, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    kinds = [[n["type"] for n in before.get("normalizers", [])], [p["type"] for p in cut.get("pretokenizers", [])]]
    if kinds != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] or model["type"] != "BPE":
        return False
    split, bytes_ = cut["pretokenizers"]
    pattern = split["pattern"].get("Regex", "")
    removed = split["behavior"] == "Removed" and split["invert"] and {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} <= set(pattern.split("|")) and all(a in (r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+") or a[0] == "'" for a in pattern.split("|"))
    blanks = before["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] or SIMPLE.fullmatch(t["content"]) for t in spec.get("added_tokens", []))
    return removed and blanks and plain and not (bytes_["add_prefix_space"] or bytes_["use_regex"] or spec.get("post_processor") or spec.get("truncation") or spec.get("padding"))


class Encoder(dict):
    """Ids of texts, little-endian unsigned 32-bit, by the tokenizers library; a dict of words so that known ones cost one lookup."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_str(spec)
        self.model = self.library.model
        self.split = separable(json.loads(spec))
        symbols = byte_symbols()
        self.symbols = {c: "".join(symbols[x] for x in chr(c).encode()) for c in range(0xC0, 0x100)}

    def _whole(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """A pre-token: the model alone gives its ids."""
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(piece.translate(self.symbols))])

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        simple = SIMPLE.fullmatch(word)
        if not simple:
            ids = self._whole(word)
        else:
            letters, signs = simple.groups()
            ids = (self.get(letters) or self._piece(letters.lower())) if letters else b""
            if signs:
                ids += self.get(signs) or self._piece(signs)
        if len(word) <= KNOWN:
            self[word] = ids
        return ids

    def _words(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def ids(self, text: str) -> bytes:
        if not self.split:
            return self._whole(text)
        parts, at = [], 0
        while len(text) - at > STRETCH and (stop := text.find(" ", at + STRETCH)) >= 0:
            parts.append(self._words(text[at:stop]))
            at = stop + 1
        return b"".join([*parts, self._words(text[at:])])


@lru_cache(1)
def encoder_for(spec: str) -> Encoder:
    """A worker keeps its words from task to task."""
    return Encoder(spec)


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int, limit: int = LIMIT) -> DataFrame:
    """doc_id, row (unique), piece, start, length and ids (binary, little-endian unsigned 32-bit) of every piece; written."""
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    rows = docs.select("doc_id", shared.text_or_empty(F.col("text")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder, end = encoder_for(sent.value), np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids"]
        for batch in batches:
            at, piece, start, length, ids, held = [], [], [], [], [], 0

            def block() -> pa.RecordBatch:
                columns = [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
                for c in (at, piece, start, length, ids):
                    c.clear()
                return pa.RecordBatch.from_arrays(columns, names)

            for i, text in enumerate(batch.column("text")):
                whole = encoder.ids(text.as_py()) + end
                for k, since in enumerate(range(0, len(whole), 4 * limit)):
                    part = whole[since : since + 4 * limit]
                    at.append(i), piece.append(k), start.append(since // 4), length.append(len(part) // 4), ids.append(part)
                held += len(whole)
                if held >= FLUSH:
                    yield block()
                    held = 0
            if at:
                yield block()

    made = rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")
    return shared.materialise(made.select("doc_id", F.monotonically_increasing_id().alias("row"), "piece", "start", "length", "ids"), "pieces")


@dataclass
class Plan:
    """Ranks `first` and up of a length, up to the next entry of it, go to sequences `base` and up, all at `offset`."""

    length: list[int]
    first: list[int]
    base: list[int]
    offset: list[int]
    sequences: int
    lower_bound: int


def knapsack(lengths: list[int], copies: list[int], values: list[float], limit: int) -> dict[int, int]:
    """How often each length (by place) is taken, up to its copies, for the largest value within the limit."""
    import numpy as np

    best, taken, items = np.zeros(limit + 1), [], []
    for k, (size, most, value) in enumerate(zip(lengths, copies, values, strict=True)):
        most, many = min(most, limit // size), 1
        while most > 0:  # 1, 2, 4, ... copies
            many = min(many, most)
            w = size * many
            with_it = best[: limit + 1 - w] + value * many
            better = with_it > best[w:]
            best[w:] = np.where(better, with_it, best[w:])
            taken.append(better)
            items.append((k, many, w))
            most, many = most - many, many * 2
    room, chosen = limit, {}
    for (k, many, w), better in zip(reversed(items), reversed(taken), strict=True):
        if room >= w and better[room - w]:
            chosen[k] = chosen.get(k, 0) + many
            room -= w
    return chosen


def configurations(lengths, counts, limit: int, rate: float) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """(places of lengths with copies, times) until all pieces are placed."""
    import numpy as np

    rng, rest = np.random.default_rng(SEED), counts.copy()
    step, half = max(1 / 64, min(1 / 2, len(lengths) / STEPS)), DRAWN // 2
    while len(there := np.flatnonzero(rest)):
        placed = 1 - rest[there] / counts[there]
        drawn = np.arange(len(there))
        if len(there) > DRAWN:
            lag = placed + step * rng.random(len(there))
            drawn = np.unique(np.concatenate([np.argpartition(lag, half)[:half], rng.choice(len(there), half)]))
        drawn, placed = there[drawn][::-1], placed[drawn][::-1]  # large ones first
        weights = lengths[drawn] * np.exp(-rate * (placed - placed.min()))
        chosen = [(int(drawn[k]), n) for k, n in knapsack(lengths[drawn].tolist(), rest[drawn].tolist(), weights.tolist(), limit).items()]
        times = max(1, int(min(min(step * counts[k], rest[k]) / n for k, n in chosen)))
        for k, n in chosen:
            rest[k] -= times * n
        yield chosen, times


def plan(histogram: dict[int, int], limit: int = LIMIT) -> Plan:
    """Whole sequences for all pieces of a histogram (length: number); lengths are 1 to limit."""
    import numpy as np

    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(k)] for k in lengths], np.int64)
    total = sum(int(k) * int(n) for k, n in zip(lengths, counts, strict=True))
    bound = max(-(-total // limit), int(counts[2 * lengths > limit].sum()))
    best: list = []
    fewest = None
    for rate in RATES:
        found = list(configurations(lengths, counts, limit, rate))
        sequences = sum(times for _, times in found)
        if fewest is None or sequences < fewest:
            best, fewest = found, sequences
        if fewest <= bound * (1 + CLOSE):
            break
    out, ranks = Plan([], [], [], [], 0, bound), [0] * len(lengths)
    for chosen, times in best:
        offset = 0
        for k, n in chosen:
            for _ in range(n):
                out.length.append(int(lengths[k])), out.first.append(ranks[k]), out.base.append(out.sequences), out.offset.append(offset)
                ranks[k] += times
                offset += int(lengths[k])
        out.sequences += times
    return out


def pack(pieces: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, Plan]:
    """The columns of pieces but for ids, if there, with sequence_id and offset; pieces (row, length, ...) must be a written table with unique rows."""
    import numpy as np

    others = [c for c in pieces.columns if c != "ids"]
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `limit` rows
    made = plan(histogram, limit)
    order = np.lexsort((made.first, made.length))
    table = {name: np.array(getattr(made, name), np.int64)[order] for name in ("length", "first", "base", "offset")}
    starts = np.searchsorted(table["length"], np.arange(limit + 2))
    sent = pieces.sparkSession.sparkContext.broadcast((table, starts))

    salts = max(1, sum(histogram.values()) // SALTED)
    salted = pieces.select(*others, F.pmod(F.xxhash64("row"), F.lit(salts)).alias("_salt"))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("row")) - 1
    ranked = salted.withColumn("_within", within).join(before, ["length", "_salt"]).select(*others, (F.col("_before") + F.col("_within")).alias("_rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts = sent.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.empty(len(rank), np.int64)
            for size in np.unique(length):
                own = length == size
                low, high = starts[size], starts[size + 1]
                at[own] = low + np.searchsorted(table["first"][low:high], rank[own], "right") - 1
            columns = [*(batch.column(c) for c in others), pa.array(table["base"][at] + rank - table["first"][at]), pa.array(table["offset"][at])]
            yield pa.RecordBatch.from_arrays(columns, [*others, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes if c != "ids")
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long"), made


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, limit: int = LIMIT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    pieces = tokenised(docs, tokenizer_path, end_id, limit)
    marked = pieces.select("doc_id", "row", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(marked, limit)[0].drop("row")


def sequences(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """sequence_id and ids (binary) of every sequence, ready to train on; pieces as `tokenised` writes them."""
    packed = pack(pieces.select("row", "length"), limit)[0].select("row", "sequence_id", "offset")
    parts = pieces.select("row", "ids").join(packed, "row").groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.unhex(F.array_join(F.transform("parts", lambda x: F.hex(x["ids"])), "")).alias("ids"))

"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as its bytes in a doubly linked list; a heap holds the rank and place of every adjacent pair that merges.
Popping the lowest rank (leftmost among equals) until the heap is empty does the merges, and the number of tokens is the
number of symbols at first minus the merges: no identifier is emitted. Special strings inside texts count as the library's
default has it: each is one token and cuts the text.

The vocabulary (bounded: one file) is read on the driver and sent to the executors. Counts of pre-tokens are kept in a map of
``CACHE`` entries per worker that starts afresh when full, so memory is bounded whatever the text.

Defined cases: null text counts as empty: 0 bytes, 0 tokens; ids, nulls and repeated rows pass through; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 400_000
LONG = 1 << 20


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class MergeCounter(dict):
    """Tokens of a pre-token; a dict so that known ones cost one lookup."""

    def __init__(self, vocabulary: bytes, pattern: str):
        import regex

        super().__init__()
        spec = json.loads(vocabulary)
        ids = spec["model"]["vocab"]
        self.first = [ids[s] for _, s in sorted(byte_symbols().items())]
        self.width = 1 << max(ids.values()).bit_length()
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(ids[left] * self.width + ids[right], (rank, ids[left + right]))
        self.find = regex.compile(pattern).findall
        self.finditer = regex.compile(pattern).finditer
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        count = self._merged(word.encode())
        if len(word) <= 64:
            self[word] = count
        return count

    def _merged(self, word: bytes) -> int:
        n = len(word)
        if n == 1:
            return 1
        merges, width = self.merges, self.width
        symbols = [self.first[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get(symbols[i] * width + symbols[i + 1])
            if found is not None:
                heap.append(found[0] * n + i)
        heapq.heapify(heap)
        done = 0
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            if symbols[i] < 0 or (j := after[i]) >= n:
                continue
            found = merges.get(symbols[i] * width + symbols[j])
            if found is None or found[0] != rank:
                continue  # one of the two has merged meanwhile
            symbols[i], symbols[j] = found[1], -1
            done += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merges.get(symbols[i] * width + symbols[k])
                if found is not None:
                    heapq.heappush(heap, found[0] * n + i)
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] * width + symbols[i])
                if found is not None:
                    heapq.heappush(heap, found[0] * n + h)
        return n - done

    def count(self, text: str) -> int:
        if self.special is None or not (cuts := len(self.special.findall(text))):
            return self._plain(text)
        return cuts + sum(map(self._plain, self.special.split(text)))

    def _plain(self, text: str) -> int:
        if len(text) > LONG:  # no list of all pre-tokens of a very long text
            return sum(self[m.group()] for m in self.finditer(text))
        return sum(map(self.__getitem__, self.find(text)))


def count_tokens(docs: DataFrame, vocabulary_path: str, pattern: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row."""
    with open(vocabulary_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = MergeCounter(sent.value, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = [counter.count(t) for t in texts]
            columns = [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(counted, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")

r"""Fill-in-middle transformation with cuts at code points.

A Split pre-tokenizer of the tokenizers library with an isolated match for every code point gives the offset of each; how many
there are is n, and the offsets of two ranks cut a text into prefix, middle and suffix. Nothing is trained. One match for each
code point of a text costs 0.9 CPU seconds a million, so the offsets have two levels: isolated matches of a block of code points
(about the root of the length, a power of two) over the whole text, and of single code points inside the blocks that are asked
for. A rank is then a block and a place in it; memory grows with the root of a text's length.

Ranks and forms come from the SHA-256 of seed, colon and decimal id, so reruns and lost executors change nothing. A text that is
empty or holds a sentinel stays plain, which makes every output reversible: `restored` rebuilds the text from output and form.

Defined cases: null text counts as empty; a null id hashes as the empty string; rows of one id get the same draws, each with its
own n; ids of any type pass through; other columns are ignored; empty input gives empty output.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MAX_BLOCK = 1 << 16
FLUSH = 1 << 23


@cache
def _matches(block: int):
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(rf"[\s\S]{{1,{block}}}" if block > 1 else r"[\s\S]"), "isolated").pre_tokenize_str


class Offsets:
    """The offsets of a text's code points, by rank."""

    def __init__(self, text: str):
        self.block = min(MAX_BLOCK, 1 << (len(text).bit_length() + 1) // 2)
        self.blocks = _matches(self.block)(text)
        self.known: dict[int, list] = {}
        self.n = (len(self.blocks) - 1) * self.block + len(self._singles(len(self.blocks) - 1)) if self.blocks else 0

    def _singles(self, k: int) -> list:
        if k not in self.known:
            self.known[k] = _matches(1)(self.blocks[k][0])
        return self.known[k]

    def __getitem__(self, rank: int) -> int:
        """Where the code point of this rank starts; where the text ends for rank n."""
        if rank == self.n:
            return self.blocks[-1][1][1] if self.blocks else 0
        k, at = divmod(rank, self.block)
        return self.blocks[k][1][0] + self._singles(k)[at][1][0]


def transform(docs: DataFrame, seed: str = "1", plain_from: int = 90, spm_below: int = 20, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output of every row.

    Of 100 draws those from `plain_from` on stay plain; of the others those below `spm_below` put the suffix first.
    """
    text = shared.text_or_empty(F.col("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), shared.text_or_empty(F.col("doc_id"))), 256)
    draw = lambda k: F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")
    plain = (text == "") | (draw(3) % 100 >= plain_from)
    for mark in sentinels:
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(draw(4) % 100 < spm_below, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), form.alias("form"), draw(1).alias("h1"), draw(2).alias("h2"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    first, second, third = sentinels

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            made, start, held = [], 0, 0

            def block(stop: int) -> pa.RecordBatch:
                n, low, high, out = zip(*made, strict=True)
                part = batch.slice(start, stop - start)
                columns = [part.column("doc_id"), pa.array(n, pa.int64()), part.column("form"), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(out, pa.string())]
                return pa.RecordBatch.from_arrays(columns, names)

            for at, value in enumerate(zip(*(batch.column(c) for c in ("text", "form", "h1", "h2")), strict=True)):
                t, form, h1, h2 = (v.as_py() for v in value)
                offsets = Offsets(t)
                n = offsets.n
                if form == "plain":
                    made.append((n, None, None, t))
                else:
                    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = offsets[low], offsets[high]
                    before, middle, after = t[:a], t[a:b], t[b:]
                    out = f"{second}{after}{first}{before}{third}{middle}" if form == "spm" else f"{first}{before}{second}{after}{third}{middle}"
                    made.append((n, low, high - low, out))
                held += len(t)
                if held >= FLUSH:
                    yield block(at + 1)
                    made, start, held = [], at + 1, 0
            if made:
                yield block(batch.num_rows)

    return rows.mapInArrow(cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The exact text of an output: a text that was cut holds no sentinel, so each stands where it was put, once."""
    first, second, third = sentinels
    middle = F.substring_index(output, third, -1)
    head = F.substring_index(output, third, 1)
    psm = F.concat(F.replace(F.substring_index(head, second, 1), F.lit(first), F.lit("")), middle, F.substring_index(head, second, -1))
    spm = F.concat(F.substring_index(head, first, -1), middle, F.replace(F.substring_index(head, first, 1), F.lit(second), F.lit("")))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and SHA-256 of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    again = restored(F.col("output"), F.col("form"))
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(again).alias("restored_sha256"))

r"""Spelling variants by full neighbourhood generation.

Every word of the vocabulary emits all its distinct deletions, replacements and insertions over the letters that the vocabulary
uses; those that are words themselves are its near words, found by a hash join on the string, so no distance is ever computed.
Three rules make the candidates of a word distinct without a look at each other: of a run of equal letters the first is deleted,
no letter is replaced by itself, and no letter is inserted right behind its equal.

A word of ten letters has about a thousand candidates and nearly all of them are no words. Therefore candidates are first made
as hashes: with the hashes of all prefixes and suffixes of a word, one multiplication and two additions give each, in numpy, for
all words of one length together. A Bloom filter over the vocabulary drops those that can't be words; only what passes becomes a
string and is shuffled to the join, which is exact. The filter has 16 bits a word and at most 2^``BITS`` bits (32 MB): it is the
only thing that is broadcast. A larger vocabulary fills it more, so that more candidates reach the join; it never loses one.

Words are counted in each task before they are shuffled, with at most ``HELD`` counts in memory at a time. A form has at least
`factor` times its word's count, so chains of forms are as long as the logarithm of the largest count; roots come by doubling.

Defined cases: null and empty texts have no words; a null id hashes as the empty string; repeated rows count each time; a word
without near words has no form and is its own root; ties for the form go to the smallest word in code-point order; words of any
length are handled; other columns are ignored; empty input gives empty output.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

RUN = "[A-Za-zÀ-ÿ]+"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
HELD = 300_000
STRETCH = 1 << 20
BITS = 28
PROBES = 4
BLOCK = 1 << 21
#: Odd multipliers of the word hash; any would do.
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, slip: int | None = None) -> DataFrame:
    """word and n of all words of at least `least_length` code points and `least_count` occurrences.

    With `slip`, a run whose CRC-32 with its document's id is a multiple of it loses one code point first: planted misspellings.
    """
    rows = docs.select(shared.text_or_empty(F.col("doc_id")).alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())

    def slipped(head: int, word: str) -> str:
        h = crc32(word.encode(), head)
        at = h % len(word)
        return word if h % slip else word[:at] + word[at + 1 :]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(RUN)
        total: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = value.as_py()
                found = runs.findall(text) if len(text) <= STRETCH else (m.group() for m in runs.finditer(text))
                head = crc32(f"{doc_id}:".encode())
                for run, n in Counter(w for w in found if len(w) >= least_length).items():
                    word = run.translate(LOWER)
                    if slip is not None:
                        word = slipped(head, word)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= HELD:
                    yield flushed()
        if total:
            yield flushed()

    counts = rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _matrices(words: list[str]):
    """(code points by row, where the words are) for each length."""
    import numpy as np

    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        size = len(words[at[0]])
        rows = max(1, BLOCK // size)
        for k in range(0, len(at), rows):
            part = at[k : k + rows]
            yield np.array([words[i] for i in part], f"<U{size}").view(np.uint32).reshape(len(part), size), part


def _powers(n: int):
    import numpy as np

    out = np.ones(n, np.uint64)
    out[1:] = BASE
    return np.multiply.accumulate(out)


def _ends(codes):
    """Hashes of the first i, and of all but the first i, code points of each row, i from 0."""
    import numpy as np

    n, size = codes.shape
    before, after, powers = np.zeros((n, size + 1), np.uint64), np.zeros((n, size + 1), np.uint64), _powers(size + 2)
    for i in range(size):
        before[:, i + 1] = before[:, i] * np.uint64(BASE) + codes[:, i]
    for i in range(size - 1, -1, -1):
        after[:, i] = codes[:, i] * powers[size - 1 - i] + after[:, i + 1]
    return before, after, powers


def _places(hashes, bits: int):
    """The PROBES bits of each hash, one array at a time."""
    import numpy as np

    h = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(MIX)
    h ^= h >> np.uint64(29)
    step = (h >> np.uint64(33)) | np.uint64(1)
    for _ in range(PROBES):
        yield h & np.uint64((1 << bits) - 1)
        h = h + step


def _passing(hashes, held, bits: int):
    """Which hashes may be in the filter."""
    import numpy as np

    at = np.arange(len(hashes))
    for k in range(PROBES):  # each probe looks only at what is left
        place = next(p for i, p in enumerate(_places(hashes[at], bits)) if i == k)
        at = at[(held[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
        if not len(at):
            break
    return at


def filter_bits(words: DataFrame, bits: int):
    """The Bloom filter of a vocabulary, as 64-bit units; bounded by `bits`, whatever the vocabulary."""
    import numpy as np

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, _ in _matrices(batch.column("word").to_pylist()):
                hashes = _ends(codes)[0][:, -1]
                places = np.unique(np.concatenate(list(_places(hashes, bits))))
                yield pa.RecordBatch.from_arrays([pa.array((places >> np.uint64(6)).astype(np.int64)), pa.array(np.uint64(1) << (places & np.uint64(63))).view(pa.int64())], ["unit", "held"])

    units = words.select("word").mapInArrow(placed, "unit long, held long").groupBy("unit").agg(F.bit_or("held").alias("held"))
    found = units.toArrow()
    out = np.zeros(max(1, (1 << bits) >> 6), np.int64)
    out[found.column("unit").to_numpy()] = found.column("held").to_numpy()
    return out.view(np.uint64)


def neighbours(codes, letters, passes):
    """(row, candidate) arrays of all distinct deletions, replacements and insertions whose hashes pass.

    codes are words of one length as code points, `letters` the alphabet; `passes` maps hashes to the places of those that pass.
    """
    import numpy as np

    n, size = codes.shape
    before, after, powers = _ends(codes)
    wide = letters.astype(np.uint64)
    step = max(1, BLOCK // max(1, len(letters)))  # (row, place) pairs at a time

    def strings(kept):
        return np.ascontiguousarray(kept, np.uint32).view(f"<U{kept.shape[1]}").ravel()

    def spliced(rows, places, new, skip: int):
        """Words with `new` before place and `skip` code points dropped there."""
        width = size + (0 if new is None else 1) - skip
        at = np.arange(width)
        shift = at[None, :] - places[:, None]
        inner = 0 if new is None else 1
        source = np.where(shift < 0, at[None, :], at[None, :] + skip - inner)
        out = codes[rows[:, None], np.clip(source, 0, size - 1)]
        if new is not None:
            out[np.arange(len(rows)), places] = new
        return strings(out)

    def pairs(places: int):
        for start in range(0, n * places, step):
            yield np.divmod(np.arange(start, min(n * places, start + step)), places)

    if size > 1:
        for rows, at in pairs(size):
            fresh = (at == 0) | (codes[rows, at] != codes[rows, np.maximum(at - 1, 0)])
            rows, at = rows[fresh], at[fresh]
            hashes = before[rows, at] * powers[size - 1 - at] + after[rows, at + 1]
            kept = passes(hashes)
            if len(kept):
                yield rows[kept], spliced(rows[kept], at[kept], None, 1)
    for skip, places in ((1, size), (0, size + 1)):
        for rows, at in pairs(places):
            head = before[rows, at] * np.uint64(BASE)
            rest = after[rows, at + skip]
            hashes = (head[:, None] + wide[None, :]) * powers[size - skip - at][:, None] + rest[:, None]
            unlike = codes[rows, at] if skip else np.where(at > 0, codes[rows, np.maximum(at - 1, 0)], 0)
            pair, letter = np.nonzero(letters[None, :] != unlike[:, None])
            kept = passes(hashes[pair, letter])
            if len(kept):
                pair, letter = pair[kept], letter[kept]
                yield rows[pair], spliced(rows[pair], at[pair], letters[letter], skip)


def near_words(words: DataFrame, count: int | None = None) -> DataFrame:
    """word, near and near_n for every pair of words at one edit; words (word, n) must be a written table of distinct words."""
    import numpy as np

    spark = words.sparkSession
    count = words.count() if count is None else count
    bits = min(BITS, max(16, (16 * count - 1).bit_length()))
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()  # the pattern bounds them
    alphabet = np.array(sorted(ord(r.c) for r in letters), np.uint32)
    sent = spark.sparkContext.broadcast((filter_bits(words, bits), alphabet))

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = sent.value
        for batch in batches:
            own = batch.column("word").to_pylist()
            for codes, at in _matrices(own):
                for rows, found in neighbours(codes, letters, lambda h: _passing(h, held, bits)):
                    yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(at[rows])), pa.array(found.tolist(), pa.string())], ["word", "near"])

    candidates = words.select("word").mapInArrow(emitted, "word string, near string")
    return candidates.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("shuffle_hash"), "near").select("word", "near", "near_n")


def group_variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of a vocabulary (word, n)."""
    words = shared.materialise(words, "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(near, "word", "left")
    takes = -F.col("best.less") >= factor * F.col("n")
    forms = known.select("word", F.when(takes, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(takes, -F.col("best.less")).alias("form_n"))
    forms = shared.materialise(forms, "word-forms", instead_of=(words,))
    chain = shared.materialise(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:  # doubling: the rounds are the logarithm of the longest chain
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = chain.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        longer = shared.materialise(longer, "roots")
        done = longer.where("moved").isEmpty()
        shared.discard(chain)
        chain = longer.select("word", "root")
        chain._written_to = longer._written_to
        if done:
            break
    return forms.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Copies among pictures by local descriptors: crops, turns, rescaling, noise, brightness and contrast edits of one picture.

Corners are found at several scales; each has the direction of its patch's intensity centroid, and 256 comparisons of pixel
pairs turned into that direction make its binary descriptor. Pictures meet in ``TABLES`` Hamming tables, keyed by ``KEY_BITS``
of the bits each: one corner that keeps the bits of one table is enough. Those that meet are verified on all their corners: descriptors
that differ in at most ``MAX_BITS`` bits are matched, and the similarity transform (scale, turn, shift) through two matches that
most others agree with must carry ``MIN_SHARED`` corners.

Rounds gather the groups: in every bucket of a table the members meet the least picture only, those that prove its copies leave the
bucket with it, and the others meet the least of what is left, for ``ROUNDS`` rounds. Then every two pictures that share a bucket but
no group are verified, in pairs of blocks, so a frequent corner (a logo, a frame) and a copy of a copy lose no link: the components
are those of all pairs that share a bucket and agree. Only pairs within a group are left out.

So `n_verified` counts a picture's verified pairs, which for a group are not all. Edited copies may keep no table's bits: recall is
measured in the tests and stated in the README.

Input: image_id long, width int, height int, pixels binary (one byte of luminance for each pixel, row by row); other columns
are ignored. Null or empty pixels, pixels that don't fill width x height, and flat or tiny pictures have no corners: they link
with nothing but exact repeats. Null image_id rows are left out; of rows of one image_id all pictures count for that id.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph, shared

LEVELS = (1.0, 1.41, 2.0)  # each scale divides the picture by this
RADIUS, BITS, TABLES, KEY_BITS = 13, 256, 16, 60
MIN_RESPONSE = 0.02  # of the strongest corner of its level
MAX_BITS, MIN_SHARED, NEAR = 40, 10, 4.0  # bits that may differ, corners that must agree, and pixels within which they do
HYPOTHESES = 48  # best matches through which transforms are laid; all matches vote
SCALES = (0.4, 2.5)
ROUNDS = 6
AT_ONCE = 4  # tables whose values are shuffled at once
BLOCK, SHIPPED = 256, 16_384  # pictures of a block, and rows with their corners that are shuffled at once
PART = 256  # pairs of one picture that a task verifies with one copy of its corners
_PAIRS = np.clip(np.random.default_rng(7).normal(0, RADIUS / 2.5, (BITS, 4)), -RADIUS / 1.5, RADIUS / 1.5)
_CHOSEN = [np.random.default_rng(t).permutation(BITS)[:KEY_BITS] for t in range(TABLES)]
_DISC = [(y, x) for y in range(-RADIUS + 4, RADIUS - 3) for x in range(-RADIUS + 4, RADIUS - 3) if y * y + x * x <= (RADIUS - 4) ** 2]
_DY, _DX = (np.array(c) for c in zip(*_DISC, strict=True))


def _box(a: np.ndarray, r: int = 1) -> np.ndarray:
    """Sums over squares of side 2r + 1; the picture is mirrored at its edges."""
    p = np.pad(a, r, mode="reflect")
    s = np.pad(p.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n = 2 * r + 1
    return s[n:, n:] - s[:-n, n:] - s[n:, :-n] + s[:-n, :-n]


def _shrunk(a: np.ndarray, by: float) -> np.ndarray:
    if by == 1.0:
        return a
    smooth = _box(a) / 9
    ys, xs = (np.rint(np.arange(int(n / by)) * by).astype(int) for n in a.shape)
    return smooth[np.minimum(ys, a.shape[0] - 1)][:, np.minimum(xs, a.shape[1] - 1)]


def corners(picture: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (complex, in pixels of the whole picture) and descriptors (four words each) of all corners."""
    places, words = [], []
    for by in LEVELS:
        a = _shrunk(picture.astype(np.float64), by)
        if min(a.shape) < 2 * RADIUS + 3:
            continue
        smooth = _box(a) / 9
        gy, gx = np.gradient(smooth)
        xx, yy, xy = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
        response = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        inner = response[RADIUS:-RADIUS, RADIUS:-RADIUS]
        if inner.max() <= 1e-6:
            continue
        wide = np.pad(inner, 2, constant_values=-np.inf)
        most = wide[:, :-4].copy()
        for k in range(1, 5):
            np.maximum(most, wide[:, k : k + inner.shape[1]], out=most)
        peak = most[:-4].copy()
        for k in range(1, 5):
            np.maximum(peak, most[k : k + inner.shape[0]], out=peak)
        ys, xs = np.nonzero((inner == peak) & (inner > MIN_RESPONSE * inner.max()))
        ys, xs = ys + RADIUS, xs + RADIUS
        soft = (_box(a, 2) / 25).ravel()
        width = a.shape[1]
        around = soft[(ys * width + xs)[:, None] + (_DY * width + _DX)]
        angle = np.arctan2((around * _DY).sum(1), (around * _DX).sum(1))
        c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
        at = lambda u, v: soft[(ys[:, None] + np.rint(s * u + c * v).astype(np.int64)) * width + xs[:, None] + np.rint(c * u - s * v).astype(np.int64)]
        tests = at(_PAIRS[:, 0], _PAIRS[:, 1]) < at(_PAIRS[:, 2], _PAIRS[:, 3]) - 1e-9
        words.append(np.packbits(tests, axis=1).view(np.uint64))
        places.append((xs + 1j * ys) * by)
    if not places:
        return np.zeros(0, np.complex128), np.zeros((0, BITS // 64), np.uint64)
    return np.concatenate(places), np.concatenate(words)


def agree(p: np.ndarray, p_words: np.ndarray, q: np.ndarray, q_words: np.ndarray) -> bool:
    """Enough corners of two pictures match and lie in one similarity transform."""
    if min(len(p), len(q)) < MIN_SHARED:
        return False
    differ = np.zeros((len(p), len(q)), np.uint16)
    for word in range(p_words.shape[1]):  # a sum along so short an axis takes several times as long
        differ += np.bitwise_count(p_words[:, word, None] ^ q_words[None, :, word])
    best = differ.argmin(1)
    least = differ[np.arange(len(p)), best]
    found = np.flatnonzero(least <= MAX_BITS)
    if len(found) < MIN_SHARED:
        return False
    found = found[np.argsort(least[found], kind="stable")]
    a, b = p[found], q[best[found]]
    n = min(len(found), HYPOTHESES)
    i, j = np.triu_indices(n, 1)
    far = (np.abs(a[j] - a[i]) > 2 * NEAR) & (np.abs(b[j] - b[i]) > 2 * NEAR)
    i, j = i[far], j[far]
    if not len(i):
        return False
    turn = (b[j] - b[i]) / (a[j] - a[i])
    size = np.abs(turn)
    real = (size > SCALES[0]) & (size < SCALES[1])
    turn, i = turn[real], i[real]
    if not len(i):
        return False
    inside = np.abs(turn[:, None] * (a[None, :] - a[i][:, None]) + b[i][:, None] - b[None, :]) < NEAR
    first = inside[inside.sum(1).argmax()]
    # Corners that two levels find at one place count once, on either side.
    return min(len({(round(z.real / 3), round(z.imag / 3)) for z in side[first]}) for side in (a, b)) >= MIN_SHARED


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """image_id, same (digest of size and pixels), n, places and words of every picture."""
    for batch in batches:
        same, counts, places, words = [], [], [], []
        ids = batch.column("image_id")
        for key, w, h, raw in zip(ids.to_pylist(), batch.column("width").to_pylist(), batch.column("height").to_pylist(), batch.column("pixels").to_pylist(), strict=True):
            at, word = np.zeros(0, np.complex128), np.zeros((0, BITS // 64), np.uint64)
            if raw and w and h and w > 0 and h > 0 and len(raw) == w * h:
                at, word = corners(np.frombuffer(raw, np.uint8).reshape(h, w))
            same.append(f"none-{key}" if raw is None else f"{w}x{h}-{hashlib.sha256(raw).hexdigest()}")
            counts.append(len(at))
            places.append(at.astype(np.complex64).tobytes())
            words.append(word.tobytes())
        columns = [ids, pa.array(same), pa.array(counts, pa.int32()), pa.array(places, pa.binary()), pa.array(words, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["image_id", "same", "n", "places", "words"])


def copies(images: DataFrame) -> DataFrame:
    """image_id, n_corners, n_verified (pairs of its class that were verified), component_id (least image_id of its copies)."""
    rows = images.where(F.col("image_id").isNotNull()).select(F.col("image_id").cast("long").alias("image_id"), F.col("width").cast("int"), F.col("height").cast("int"), "pixels")
    described = shared.materialise(rows.mapInArrow(_described, "image_id long, same string, n int, places binary, words binary"), "descriptors")
    classes = described.groupBy("same").agg(F.min("image_id").alias("class_id"))
    members = shared.materialise(described.select("image_id", "same", "n").join(classes, "same").select("image_id", "class_id", "n").distinct(), "picture-classes")
    chosen = described.join(classes, "same").where((F.col("image_id") == F.col("class_id")) & (F.col("n") >= MIN_SHARED))
    chosen = shared.materialise(chosen.dropDuplicates(["same"]).select("class_id", "places", "words"), "class-descriptors", instead_of=(described,))
    links = _links(chosen)
    found = graph.connected_components(links.unionByName(members.select(F.col("image_id").alias("u"), F.col("class_id").alias("v"))))
    sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    verified = sides.groupBy(F.col("u").alias("class_id")).agg(F.count("*").alias("links"))
    whole = members.groupBy("image_id").agg(F.min("class_id").alias("class_id"), F.max("n").alias("corners"))
    whole = whole.join(verified, "class_id", "left").join(found, F.col("image_id") == F.col("node"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    done = whole.select("image_id", zero(F.col("corners")).alias("n_corners"), zero(F.col("links")).alias("n_verified"), F.col("component").alias("component_id"))
    return shared.materialise(done, "picture-groups", instead_of=(members, chosen, links, found))


def _values(batches: Iterator[pa.RecordBatch], tables: range = range(TABLES)) -> Iterator[pa.RecordBatch]:
    """key (of a descriptor's bits in one of `tables`, whose number is in the last four bits) and class_id, each once for a picture."""
    for batch in batches:
        keys, ids = [], []
        for key, raw in zip(batch.column("class_id").to_pylist(), batch.column("words").to_pylist(), strict=True):
            bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8), axis=1)
            words = np.stack([np.ascontiguousarray(np.packbits(bits[:, c], axis=1)).view(np.uint64)[:, 0] for c in (_CHOSEN[t] for t in tables)])
            words = (words ^ (words >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            words = (words ^ (words >> np.uint64(32))) & ~np.uint64(15) | np.array(tables, np.uint64)[:, None]
            mine = np.unique(words).view(np.int64)
            keys.append(mine)
            ids.append(np.full(len(mine), key, np.int64))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], ["key", "class_id"])


def _links(chosen: DataFrame) -> DataFrame:
    """u, v: pairs of classes that were verified to be copies. Classes that share a value and agree are linked or in one group."""
    spark = chosen.sparkSession
    # A value of one picture alone brings nothing together. Some tables at a time: their values are many, those of several pictures are few.
    parts = []
    for first in range(0, TABLES, AT_ONCE):
        of = partial(_values, tables=range(first, min(TABLES, first + AT_ONCE)))
        parts.append(_several(chosen.mapInArrow(of, "key long, class_id long")))
    met = reduce(DataFrame.unionByName, parts)
    links = shared.materialise(spark.createDataFrame([], "u long, v long"), "picture-links")
    tested = shared.materialise(spark.createDataFrame([], "u long, v long"), "tested-pairs")
    links, tested = _rounds(met, chosen, links, tested, ROUNDS)
    shared.discard(tested)
    found = _rest(met, chosen, links)
    shared.discard(*parts)
    return found


def _rest(met: DataFrame, chosen: DataFrame, links: DataFrame) -> DataFrame:
    """links and those of all pairs that share a value but are in different groups by `links`.

    Classes are dealt to blocks of about BLOCK, and a task holds two blocks, whatever the number of members that a value has. Pairs of blocks
    are dealt in slices, so that no more than SHIPPED rows with their corners are shuffled at once. The pairs grow with the square
    of the classes that share values.
    """
    groups = graph.connected_components(links)
    keys = met.groupBy("class_id").agg(F.collect_list("key").alias("keys"))
    rows = chosen.join(keys, "class_id").join(groups.withColumnRenamed("node", "class_id"), "class_id", "left")
    rows = shared.materialise(rows.select("class_id", F.coalesce("component", "class_id").alias("component"), "keys", "places", "words"), "rest", instead_of=(groups,))
    n = rows.count()
    blocks = -(-n // BLOCK)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("class_id"), F.lit(max(1, blocks))).cast("int"))
    slices = -(-n * blocks // SHIPPED)
    for turn in range(slices):
        other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
        copied = dealt.select("*", other).select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        copied = copied.where(F.pmod(F.xxhash64("i", "j"), F.lit(slices)) == turn).repartition("i", "j").sortWithinPartitions("i", "j")
        found = copied.select("i", "j", "block", "class_id", "component", "keys", "places", "words").mapInArrow(_blocks, "u long, v long")
        links = shared.materialise(links.unionByName(found), "picture-links", instead_of=(links,))
    shared.discard(rows)
    return links


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of two blocks (or within one) that share a value, are in different groups and agree."""
    for (i, j), rows in shared.groups(batches, ["i", "j"]):
        block, ids, group = (rows.column(c).to_pylist() for c in ("block", "class_id", "component"))
        found = [(np.frombuffer(p, np.complex64), np.frombuffer(w, np.uint64).reshape(-1, BITS // 64)) for p, w in zip(rows.column("places").to_pylist(), rows.column("words").to_pylist(), strict=True)]
        having, us, vs = {}, [], []
        for b, keys in enumerate(rows.column("keys").to_pylist()):
            met = set()
            for key in keys:
                others = having.setdefault(key, [])
                met.update(others)
                others.append(b)
            for a in met:
                if group[a] != group[b] and (i == j or block[a] != block[b]):
                    u, v = sorted((a, b), key=ids.__getitem__)
                    if agree(*found[u], *found[v]):
                        us.append(ids[u])
                        vs.append(ids[v])
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])


def _several(table: DataFrame) -> DataFrame:
    """Rows of keys that several classes have."""
    dealt = table.repartition("key")  # one shuffle, which both sides read
    keys = dealt.groupBy("key").agg(F.min("class_id").alias("least"), F.max("class_id").alias("most")).where("least < most").select("key")
    return shared.materialise(dealt.join(keys.hint("shuffle_hash"), "key"), "hamming-table")


def _rounds(met: DataFrame, chosen: DataFrame, links: DataFrame, tested: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """links and tested after at most so many rounds in which every key's members meet the least of them; met stays."""
    left, turn = met, 0
    while turn < most and not left.isEmpty():
        turn += 1
        hubs = left.groupBy("key").agg(F.min("class_id").alias("hub"))
        meetings = shared.materialise(left.join(hubs.hint("shuffle_hash"), "key").where("class_id > hub"), "hamming-meetings", instead_of=(left,) if left is not met else ())
        pairs = meetings.select(F.col("hub").alias("u"), F.col("class_id").alias("v")).distinct()
        new = shared.materialise(pairs.join(tested, ["u", "v"], "left_anti"), "new-pairs")
        agreed = _verified(new, chosen)
        links = shared.materialise(links.unionByName(agreed), "picture-links", instead_of=(links,))
        tested = shared.materialise(tested.unionByName(new), "tested-pairs", instead_of=(tested,))
        done = links.select(F.col("u").alias("hub"), F.col("v").alias("class_id"))
        left = _several(meetings.join(done, ["hub", "class_id"], "left_anti").select("key", "class_id"))
        shared.discard(meetings, new)
    if left is not met:
        shared.discard(left)
    return links, tested


def _verified(pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The pairs (u, v) whose corners agree. A picture with many partners is read once for every PART of them, by salt."""
    parts = pairs.groupBy("u").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    salted = pairs.join(parts, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("salt"))
    named = lambda side: chosen.select(F.col("class_id").alias(side), F.struct("places", "words").alias(f"{side}_corners"))
    hubs = named("u").join(parts, "u").select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "u_corners")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lambda c: (np.frombuffer(c["places"], np.complex64), np.frombuffer(c["words"], np.uint64).reshape(-1, BITS // 64))
        for batch in batches:
            ok = [agree(*read(u.as_py()), *read(v.as_py())) for u, v in zip(batch.column("u_corners"), batch.column("v_corners"), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return salted.join(named("v"), "v").join(hubs, ["u", "salt"]).select("u", "v", "u_corners", "v_corners").mapInArrow(checked, "u long, v long")


#: Edits of drawn pictures.
EDITS = ("whole", "left crop", "right crop", "brighter", "contrast", "noise", "quarter turn", "smaller", "turned")


def _sampled(a: np.ndarray, ys: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Bilinear values at places inside the picture."""
    y0, x0 = np.clip(np.floor(ys).astype(int), 0, a.shape[0] - 2), np.clip(np.floor(xs).astype(int), 0, a.shape[1] - 2)
    dy, dx = np.clip(ys - y0, 0, 1), np.clip(xs - x0, 0, 1)
    return (a[y0, x0] * (1 - dx) + a[y0, x0 + 1] * dx) * (1 - dy) + (a[y0 + 1, x0] * (1 - dx) + a[y0 + 1, x0 + 1] * dx) * dy


def edited(a: np.ndarray, edit: str, rng: np.random.Generator) -> np.ndarray:
    n = a.shape[0]
    if edit == "left crop":
        return a[: n - 9, rng.integers(3, 14) :]
    if edit == "right crop":
        return a[rng.integers(3, 14) :, : n - 9]
    if edit == "brighter":
        return a + 30
    if edit == "contrast":
        return (a - 110) * 1.25 + 115
    if edit == "noise":
        return a + rng.normal(0, 4, a.shape)
    if edit == "quarter turn":
        return np.rot90(a)
    if edit == "smaller":
        at = np.arange(int(n * 0.8)) / 0.8
        return _sampled(_box(a) / 9, at[:, None] + 0 * at, at[None, :] + 0 * at[:, None])
    if edit == "turned":
        t, r = 0.26, np.arange(n) - (n - 1) / 2
        y, x = np.cos(t) * r[:, None] - np.sin(t) * r[None, :], np.sin(t) * r[:, None] + np.cos(t) * r[None, :]
        return _sampled(a, y + (n - 1) / 2, x + (n - 1) / 2)
    return a


def scene(seed: int, side: int = 96) -> np.ndarray:
    """A drawing of boxes with grain; every fourth one bears the same mark."""
    rng = np.random.default_rng(seed + 1)
    a = np.full((side, side), 90.0)
    for y, x, h, w, v in zip(rng.integers(0, side, 60), rng.integers(0, side, 60), rng.integers(4, 20, 60), rng.integers(4, 20, 60), rng.integers(20, 180, 60), strict=True):
        a[y : y + h, x : x + w] = v
    a += rng.normal(0, 22, ((side + 1) // 2, (side + 1) // 2)).repeat(2, 0).repeat(2, 1)[:side, :side]
    if seed % 4 == 0:
        y, x = rng.integers(16, side - 40, 2)
        a[y : y + 22, x : x + 22] = np.random.default_rng(0).integers(20, 200, (11, 11)).repeat(2, 0).repeat(2, 1)
    return np.clip(a, 5, 210)


def drawn(pages: DataFrame, side: int = 96) -> DataFrame:
    """A picture for every page, since no table holds any.

    Of seven pages one shows the same scene, so a hot group holds a seventh of all rows; the others share scenes by three.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pictures = []
            ids = batch.column("page_id").to_pylist()
            for key in ids:
                rng = np.random.default_rng([int(key), 5])
                a = scene(0 if key % 7 == 0 else 1 + int(key) // 3, side)
                a = edited(a, EDITS[int(rng.integers(len(EDITS)))], rng)
                pictures.append(np.ascontiguousarray(np.clip(np.rint(a), 0, 255).astype(np.uint8)))
            columns = [pa.array(ids, pa.int64()), pa.array([p.shape[1] for p in pictures], pa.int32()), pa.array([p.shape[0] for p in pictures], pa.int32()), pa.array([p.tobytes() for p in pictures], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["image_id", "width", "height", "pixels"])

    return pages.where(F.col("page_id").isNotNull()).select(F.col("page_id").cast("long").alias("page_id")).mapInArrow(draw, "image_id long, width int, height int, pixels binary")

"""Pictures that share a bucket and no group are all verified, however many unrelated ones share it."""

import numpy as np
import pyarrow as pa
import pytest

from commitloom.llm import media_copies


@pytest.mark.parametrize("rounds", [0, 1])
def test_rounds_that_end_early_lose_no_link(spark, monkeypatch, rounds):
    pages = spark.range(64).withColumnRenamed("id", "page_id")
    rows = media_copies.drawn(pages).orderBy("image_id").collect()
    first = {}
    for r in rows:
        first.setdefault((r.width, r.height, bytes(r.pixels)), r.image_id)
    found = {first[r.width, r.height, bytes(r.pixels)]: media_copies.corners(np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width)) for r in rows}
    batch = pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([w.tobytes() for _, w in found.values()], pa.binary())], ["class_id", "words"])
    keys = {k: set() for k in found}
    for out in media_copies._values(iter([batch])):
        for key, k in zip(out.column("key").to_pylist(), out.column("class_id").to_pylist(), strict=True):
            keys[k].add(key)
    as_read = {k: (p.astype(np.complex64), w) for k, (p, w) in found.items()}
    want = {k: k for k in found}
    for a in sorted(found):
        for b in sorted(k for k in found if k > a):
            if keys[a] & keys[b] and want[a] != want[b] and media_copies.agree(*as_read[a], *as_read[b]):
                low, high = sorted((want[a], want[b]))
                want = {k: low if c == high else c for k, c in want.items()}
    monkeypatch.setattr(media_copies, "ROUNDS", rounds)
    monkeypatch.setattr(media_copies, "BLOCK", 10, raising=False)
    monkeypatch.setattr(media_copies, "SHIPPED", 150, raising=False)
    got = {r.image_id: r.component_id for r in media_copies.copies(media_copies.drawn(pages)).collect()}
    assert got == {r.image_id: want[first[r.width, r.height, bytes(r.pixels)]] for r in rows}
    assert len(set(got.values())) < len(found)

"""Marks of the n-gram join are dealt with slice by slice."""

import random

from commitloom.llm import ngram_join, shared


def test_marks_go_in_slices(spark, monkeypatch):
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcdefghij") + str(draw.randrange(30)) for _ in range(40)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t.rsplit(" ", 1)[0]) for i, t in enumerate(texts[:30])] + [(300, texts[0]), (301, None), (302, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels, kept = [], shared.materialise

    def counted(df, label, *a, **b):
        labels.append(label)
        return kept(df, label, *a, **b)

    monkeypatch.setattr(shared, "materialise", counted)
    got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(docs, 3, 90).collect()}
    assert labels.count("frequent-marks") == labels.count("met-marks") == ngram_join.SLICES > 1
    assert got == {i: i for i in range(60)} | {100 + i: i for i in range(30)} | {300: 0, 301: 301, 302: 302}


def test_marks_are_on_disk_once(spark, monkeypatch):
    """Beside all marks, no more than one slice of them is written or moved at a time."""
    texts = [" ".join(f"w{i * 7 + k}" for k in range(60)) for i in range(40)]
    docs = spark.createDataFrame([*enumerate(texts), (90, texts[3])], "doc_id long, text string")
    kept, seen, live = shared.materialise, {}, {}

    def watched(df, label, block_mb=128, instead_of=()):
        made = kept(df, label, block_mb)
        n = {c: made.selectExpr(f"sum(size(flatten({c})))").first()[0] for c in made.columns if c.startswith("marks")}
        live[made._written_to] = sum(n.values())
        seen.setdefault(label, []).append((sum(n.values()), sum(live.values())))
        for table in instead_of:
            live.pop(table.__dict__.get("_written_to"), None)
        shared.discard(*instead_of)
        return made

    monkeypatch.setattr(shared, "materialise", watched)
    ngram_join.similar_groups(docs, 3, 90).collect()
    (every, _), held = seen["shingles"][0], seen["class-marks"]
    assert len(held) == ngram_join.SLICES and 0 < every * 0.9 < sum(n for n, _ in held) < every  # the copy is left out
    assert max(total for _, total in held) < every * 1.4

"""The rounds of a walk move numbers, not hashes."""

from commitloom.operators import walk
from commitloom.sources import scratch


def test_rounds_hold_no_hashes(spark, monkeypatch):
    seen, kept = [], scratch.written

    def watched(rows, label):
        seen.append((label, dict(rows.dtypes)))
        return kept(rows, label)

    monkeypatch.setattr(scratch, "written", watched)
    rows = [(f"c{i:02}", [f"c{i - 1:02}"] if i % 10 else [], 100 - i) for i in range(30)] + [("c05", ["c04"], 3), (None, ["c01"], 1), ("late", ["c29", "c09"], None)]
    table = spark.createDataFrame(rows, "commit_hash string, parents array<string>, commit_time long")
    got = {r.commit_hash: r.position for r in walk.walk(table, spark.createDataFrame([("c15",), ("unknown",)], "commit_hash string")).collect()}
    assert got == {f"c{10 + i}": i for i in range(6)}
    rounds = [types for label, types in seen if label in ("edges", "jumps", "times", "late", "walked")]
    assert len(rounds) > 5 and all("string" not in types.values() for types in rounds)
    every = {r.commit_hash: r.position for r in walk.walk(table).collect()}
    assert sorted(every.values()) == list(range(31)) and every["late"] > every["c29"] and every["late"] > every["c09"]

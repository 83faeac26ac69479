"""Golden rows of the derivations, scores and text rules."""

import pytest
from pyspark.sql import functions as F

from commitloom.functions import diffs, paths
from commitloom.operators import chains, context, derive, score, validate
from commitloom.plans import model_calls
from commitloom.sources import io


def one(spark, **columns):
    """A row of the given expressions."""
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


@pytest.mark.parametrize(
    ("path", "ext", "sub"),
    [
        ("kernel/sched/core.c", ".c", "kernel/sched"),
        ("kernel/fork.c", ".c", "kernel"),
        ("mm/slub.c", ".c", "mm"),
        ("drivers/net/ethernet/intel/e1000/e1000.c", ".c", "drivers/net"),
        ("arch/x86/entry/entry_64.S", ".S", "arch/x86"),
        ("include/linux/sched.h", ".h", "include"),
        ("Makefile", "", "root"),
        ("init/main.c", ".c", "init/main.c"),
        ("lib/a.b/Makefile", ".b/Makefile", "lib/a.b"),
    ],
)
def test_paths(spark, path, ext, sub):
    assert tuple(one(spark, e=paths.extension(F.lit(path)), s=paths.subsystem(F.lit(path)))) == (ext, sub)


SCORED = [
    ("mm: return the spare pages of a pool", "The pool keeps them because its last user only drops the lock.\nSigned-off-by: A", 2, 1, 1, 0, "abc1234", 100),
    ("docs: correct a typo of the index", "letters only", 50, 0, 0, 0, None, 0),
    ("fs: hold the list lock", "readers fail because entries move", 1, 0, 0, 0, None, 45),
    ("fs: order the entries", "by name, not by age", 1, 0, 0, 0, None, 30),
    ("subj", "plain", 0, 0, 0, 0, None, 20),
    ("subj", "plain", 21, 0, 0, 0, None, 0),
    ("subj", "x" * 200, 1, 1, 1, 1, None, 85),
    ("stylesheet: add", "plain", 1, 0, 0, 0, None, 30),
]


@pytest.mark.parametrize("row", SCORED, ids=lambda r: r[0][:10] + r[1][:10])
def test_heuristic_score(spark, row):
    subject, body, files, s, r, a, fixes, want = row
    df = spark.createDataFrame([(subject, body, files, ["x"] * s, ["x"] * r, ["x"] * a, fixes)], "subject string, body string, files_changed int, signed_off_by array<string>, reviewed_by array<string>, acked_by array<string>, fixes_hash string")
    assert score.with_score(df).first()["heuristic_score"] == want


@pytest.mark.parametrize(
    ("subject", "body", "bits"),
    [("drm: fix use-after-free in foo", "Fixes a race condition and cleanup", 21), ('Revert "mm: speed up alloc"', "This reverts commit 0123456789abcdef", 66), ("x86: update", "(cherry picked from commit abc)", 32), ("plain", "nothing here", 0), ("usb: CVE-2020-1234 doc", "-", 25)],
)
def test_tags(spark, subject, body, bits):
    df = spark.createDataFrame([("c", subject, body)], "commit_hash string, subject string, body string")
    got = score.commit_tags(df).first()
    assert (got["flags"] if got else 0) == bits


def test_trailers(spark):
    m = F.lit('s\n\nb\nFixes: abc1234 ("x")\nSigned-off-by: A <a@x>\nSigned-off-by: B <b@x>')
    assert tuple(one(spark, f=derive.fixes_hash(m), s=derive.trailers(m, "Signed-off-by"))) == ("abc1234", ["A <a@x>", "B <b@x>"])
    assert one(spark, f=derive.fixes_hash(F.lit("s\n\n Fixes: abc1234")))[0] is None


def test_commit_and_file_rows(spark):
    raw = spark.createDataFrame([("h1", "subject \n\n body\nSigned-off-by: A", None, "e", "", "e", 0, 60, ["p", "q"])], "commit_hash string, message string, author_name string, author_email string, committer_name string, committer_email string, author_time bigint, commit_time bigint, parents array<string>")
    c = derive.commit_rows(raw).first()
    assert (c.subject, c.body, c.author_name, c.is_merge, c.parent_count, c.signed_off_by) == ("subject", "body\nSigned-off-by: A", "Unknown", 1, 2, ["A"])
    deltas = spark.createDataFrame(
        [("h1", "M", "mm/a.c", "mm/a.c", False, "@@ -1 +1 @@\n-x\n+y\n+z", "x", "y"), ("h1", "D", "fs/b.c", None, False, None, None, None), ("h1", "A", None, "x.png", False, "", "", ""), ("h1", "A", None, "Documentation/x", False, "", "", "")],
        "commit_hash string, status string, old_path string, new_path string, is_binary boolean, patch string, code_before string, code_after string",
    )
    f = {r.file_path: r for r in derive.file_rows(deltas).collect()}
    assert set(f) == {"mm/a.c", "fs/b.c"}
    assert (f["mm/a.c"].lines_added, f["mm/a.c"].lines_deleted, f["fs/b.c"].diff_hunk) == (2, 1, "")
    totals = derive.with_file_totals(derive.commit_rows(raw), derive.file_rows(deltas)).first()
    assert (totals.files_changed, totals.total_additions, totals.total_deletions) == (2, 2, 1)


def test_prefix_chains(spark):
    full = "0123456789abcdef" * 2 + "01234567"
    df = spark.createDataFrame([(full, "a", "b", None), ("f" * 40, 'Revert "a"', f"This reverts commit {full[:14]}.", full)], "commit_hash string, subject string, body string, fixes_hash string")
    assert sorted((r.buggy_commit, r.chain_type) for r in chains.chains(df).collect()) == [(full, "fixes"), (full, "revert")]


def test_hunks_and_ranges(spark):
    got = one(spark, h=diffs.hunks(F.lit("@@ -3,2 +4,5 @@ f\n@@ -9 +9 @@")))[0]
    assert [tuple(h) for h in got] == [(3, 2, 4), (9, 1, 9)]
    assert context.merged([(1, 3), (7, 9), (20, 21)]) == [(1, 9), (20, 21)]
    df = spark.createDataFrame([("a", 1, 3), ("a", 7, 9), ("a", 20, 21)], "k string, first int, last int")
    assert sorted(tuple(r)[1:] for r in context.merge_ranges(df, "k").collect()) == [(1, 9), (20, 21)]


def test_function_region():
    code = "\n".join([*(f"int g{i};" for i in range(30)), "static int fn(void)", "{", "\tint a;", "\treturn 0;", "}", *(f"int h{i};" for i in range(30))])
    got = context.region(code, "@@ -33,1 +33,1 @@\n-\tint a;\n+\tint b;", 8000)
    assert "static int fn(void)" in got and "return 0" in got and "g0;" not in got
    assert context.region(None, "x", 10) == "" and context.region("abc", "", 2) == "ab"


def test_validation(spark):
    ok, src, diff = "x" * 60 + "\nbody", "y" * 60, "diff --git a/x b/x\n@@ -1 +1 @@\n" + "+z\n" * 20
    why = lambda i, s, o: one(spark, r=validate.invalid_reason(F.lit(i), F.lit(s), F.lit(o)))[0]
    assert why(ok, src, diff) is None
    assert why("short", src, diff).startswith("Instruction too short")
    assert why(ok, "", diff).startswith("Input too short")
    assert why(ok, src, diff + "z" * 9000).startswith("Output too long")
    assert why("Merge branch " + ok, src, diff).startswith("Merge commit")
    assert why("x" * 60, src, diff).startswith("Instruction has no body")


def test_replies_and_calls(spark):
    for reply, want in [('{"score": 4, "reason": "good"}', (4.0, "good")), ("I say 3", (3.0, "I say 3")), ("none", (None, None))]:
        assert tuple(one(spark, **dict(zip("vr", score.parse_reply(F.lit(reply)), strict=True)))) == want

    def ask(p):
        if p == "bad":
            raise ValueError("no")
        return p.upper()

    rows = {r.prompt: (r.reply, r.error) for r in model_calls.call(spark.createDataFrame([("a",), ("bad",)], "prompt string"), ask).collect()}
    assert rows == {"a": ("A", None), "bad": (None, "no")}


def test_json_lines_and_resumption(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"instruction":"a","input":"b","output":"c"}\nnot json\n{"instruction":"a"}\n')
    bad = {r.fault for r in io.missing_fields(spark, str(tmp_path / "x.jsonl")).collect()}
    assert bad == {"Invalid JSON", "missing output"}
    rows = spark.createDataFrame([("a",), ("b",)], "commit_hash string")
    assert [r[0] for r in io.unseen(rows, rows.where("commit_hash = 'a'")).collect()] == ["b"]

"""Readers, writers, stored tables and streams: written, read back and compared."""

import json

import pytest
from pyspark.sql import functions as F

from commitloom.functions import charset, text
from commitloom.operators import context, validate
from commitloom.plans import export, model_calls, reply_ledger, reports
from commitloom.sources import io, versioned
from commitloom.streaming import ingest


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_function_at_the_ends_of_a_file():
    assert context.function_range(["int a;", "int f(void) { return 0; }"], 2) == (1, 1)
    assert context.function_range(["int f(void) { return 0; }"], 1) == (0, 0)
    lines = ["static int g(int x)", "{", "\treturn x;", "}", "", "int h(void)", "{", "\tx = 1;", "\ty = 2;", "\treturn 2;", "}"]
    assert [context.function_range(lines, n) for n in (1, 3, 4, 6, 11)] == [(0, 3), (0, 3), (0, 3), (5, 10), (5, 10)]
    assert context.function_range(["int a;", "int b;"], 2) is None and context.function_range(lines, 12) is None
    diff = "@@ -10,2 +10,2 @@\n-\treturn 2;\n+\treturn 3;\n }"
    assert context.region("\n".join(lines), diff, 1000) == "\n".join(lines[2:])


RUSSIAN = "Это исправление убирает утечку памяти в драйвере сети и проверку указателя."
GOLDEN = {
    "cp1252": "Le paramètre réglé à zéro était ignoré; größere Werte führten früher zu Fehlern – señal débil.",
    "cp1251": RUSSIAN,
    "koi8_r": RUSSIAN,
    "shift_jis": "このパッチはメモリの漏れを修正します。カーネルの設定を確認してください。",
    "euc_jp": "このパッチはメモリの漏れを修正します。カーネルの設定を確認してください。",
    "gb18030": "这个补丁修复了网络驱动程序中的内存泄漏问题，并检查指针是否为空。",
    "big5": "這個修補程式修正了網路驅動程式中的記憶體洩漏問題，並檢查指標是否為空。",
    "euc_kr": "이 패치는 네트워크 드라이버의 메모리 누수를 수정하고 포인터를 검사합니다.",
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_charsets(spark, name):
    code = "/* comment */ int x = 1;\n"
    text = code + GOLDEN[name] + "\n" + code
    rows = spark.createDataFrame([(bytearray(text.encode(name)), text), (bytearray((text * 3).encode(name)), text * 3)], "content binary, want string")
    assert charset.charset(text.encode(name)) == name
    assert rows.where(io.decoded(F.col("content")) != F.col("want")).isEmpty()


def test_charsets_of_blobs_that_the_limit_cuts(spark):
    for name in ("shift_jis", "gb18030", "cp1251", "euc_kr"):
        raw = (GOLDEN[name] * 3000).encode(name)
        for limit in (100_000, 99_999, 99_998):
            got = spark.createDataFrame([(bytearray(raw),)], "content binary").select(io.decoded(F.col("content"), limit)).first()[0]
            assert got == raw[:limit].decode(name, "replace") and got[:50] == (GOLDEN[name] * 2)[:50]


def test_decoded_utf8(spark):
    cases = [
        (b"plain", "plain"), (b"", ""), (None, None), ("é𝄞".encode(), "é𝄞"), (b"a\0b", ""), (b"a" * 8000 + b"\0", "a" * 8000 + "\0"),
        (b"x" * 99_999 + "é".encode(), "x" * 99_999 + "�"), (b"x" * 99_997 + "𝄞".encode(), "x" * 99_997 + "�"), (b"x" * 99_998 + "é".encode() + b"tail", "x" * 99_998 + "é"), (b"x" * 100_000 + b"y", "x" * 100_000),
    ]
    rows = spark.createDataFrame([(i, None if c is None else bytearray(c)) for i, (c, _) in enumerate(cases)], "i int, content binary")
    got = {r.i: r.t for r in rows.select("i", io.decoded(F.col("content")).alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"instruction": "é", "input": null, "output": "o", "_lines_changed": 3}\n\n  \t\nno json\n[1, 2]\n"text"\n{"instruction": "cut\n{"instruction": 5, "more": {"a": 1}}\n', encoding="utf-8")
    rows = io.read_json_lines(spark, str(tmp_path / "x.jsonl"))
    assert rows.where("_corrupt_record IS NOT NULL").count() == 4 and rows.where("_corrupt_record IS NULL").count() == 2
    assert {r.line for r in io.bad_lines(spark, str(tmp_path / "x.jsonl")).collect()} == {"no json", "[1, 2]", '"text"', '{"instruction": "cut'}
    good = {r.instruction: r for r in rows.where("_corrupt_record IS NULL").collect()}
    assert good["é"]._lines_changed == 3 and good["é"].input is None and "5" in good
    io.write_json_lines(rows.where("_corrupt_record IS NULL").drop("_corrupt_record"), str(tmp_path / "out"), files=1)
    assert {r.instruction for r in io.read_json_lines(spark, str(tmp_path / "out")).collect()} == {"é", "5"}
    assert sum(1 for f in (tmp_path / "out").glob("part-*")) == 1
    faults = {r.number: r.fault for r in io.missing_fields(spark, str(tmp_path / "x.jsonl")).collect()}
    assert faults[4] == "Invalid JSON" and faults[8] == "missing output"
    assert [(r.number, r.line) for r in io.first_lines(spark, str(tmp_path / "x.jsonl"), 4).orderBy("number").collect()][3] == (4, "no json")


def test_fan_out_by_subsystem(spark, tmp_path):
    rows = spark.createDataFrame([("net/core", i, f"t{i}") for i in range(5)] + [("mm", 9, "m"), (None, 1, "n")], "subsystem string, k int, text string")
    io.write_by_subsystem(rows, str(tmp_path / "all"))
    assert {f.name for f in (tmp_path / "all").glob("_folder=*")} >= {"_folder=net_core", "_folder=mm"}
    assert spark.read.json(str(tmp_path / "all")).count() == 7
    io.write_by_subsystem(rows, str(tmp_path / "some"), limit=2, order=("k",))
    assert sorted(r.k for r in spark.read.json(str(tmp_path / "some/_folder=net_core")).collect()) == [0, 1]


def test_tables_and_appends(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS loom_test")
    try:
        io.create_tables(spark, "loom_test")
        io.create_tables(spark, "loom_test")
        assert {t.name for t in spark.catalog.listTables("loom_test")} == set(io.TABLES)
        assert spark.table("loom_test.commits").columns[0] == "commit_hash"
    finally:
        spark.sql("DROP DATABASE loom_test CASCADE")
    old = io.evolve(spark.createDataFrame([("c", "5", 1)], "Commit_Hash string, flags string, extra int"), io.TAGS)
    assert old.dtypes == [("commit_hash", "string"), ("flags", "int"), ("tags", "array<string>"), ("extra", "int")] and tuple(old.first()) == ("c", 5, None, 1)
    for part in (["b", "a"], ["c"]):
        io.append(spark.createDataFrame([(x,) for x in part], "commit_hash string"), str(tmp_path / "t"), key="commit_hash")
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "b", "c"]
    io.dry_run(old)


def test_unions_batches_and_counts(spark, tmp_path):
    a, b = spark.createDataFrame([("x", 1)], "t string, n int"), spark.createDataFrame([("y", True)], "t string, is_synthetic boolean")
    assert sorted(map(tuple, io.with_synthetic(a, b).collect()), key=repr) == [("x", 1, None), ("y", None, True)]
    sizes = [len(p) for p in io.batches(spark.range(25, numPartitions=4), 10)]
    assert sizes == [10, 10, 5]
    rows, seen = io.counted(spark.createDataFrame([("é", 1), (None, 2)], "t string, n int"))
    rows.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows": 2, "bytes": 2}


def test_reports_cards_and_grades(spark):
    columns = "commit_hash string, subject string, body string, heuristic_score double, ai_quality_score double, ai_score_reason string, is_merge int, files_changed int, fixes_hash string"
    commits = spark.createDataFrame([(k, "s", "b", h, ai, "", 0, 1, None) for k, h, ai in (("a", 50.0, 4.0), ("b", 50.0, None), ("c", 10.0, None), ("d", 30.0, None))], columns)
    assert tuple(reports.ai_progress(commits).first()) == (1, 2, pytest.approx(100 / 3)) and reports.ai_progress(commits.where("false")).first().percent == 0
    grades = spark.createDataFrame([(p,) for p in (90.0, 89.9, 75.0, 50.0, 49.9)], "p double").select(validate.coverage_grade(F.col("p")).alias("g")).collect()
    assert [r.g for r in grades] == ["PASS", "GOOD", "GOOD", "WARN", "FAIL"]
    card = reports.dataset_card("Set", {"gold": 12000, "all": 5}, {"gold": "best ones"}, "cc-by-4.0", ("en", "de"), ("code",), {"coverage": 91.256}, "2025-01-02")
    front, rest = card.split("---\n")[1:]
    assert front == "license: cc-by-4.0\nlanguage:\n- en\n- de\ntags:\n- code\nsize_categories:\n- 10K<n<100K\n"
    assert "# Set\n\n12,005 records" in rest and "| gold | 12,000 | best ones |\n| all | 5 |  |" in rest and "* coverage: 91.26" in rest and 'read.json("gold")' in rest and "`quality_reason`" in rest and rest.endswith("Made on 2025-01-02\n")
    assert "Metrics" not in reports.dataset_card("Set", {}) and "n<1K" in reports.dataset_card("Set", {})
    assert tuple(reports.sizes(spark.createDataFrame([("abcd", "x"), (None, "xyz")], "input string, output string")).first()) == (2.0, 2.0)
    assert one(spark, t=export.chatml_record(F.lit("s"), F.lit("u"), F.lit("a"))).t == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>"


def test_rewritten_gems(spark):
    diff = "diff --git a/f.c b/f.c\n--- a/f.c\n+++ b/f.c\n@@ -1,3 +1,3 @@\n int f(void)\n {\n-\treturn old_value_of_it;\n+\treturn new_value_of_it;\n }\n"
    code = "int f(void)\n{\n\treturn old_value_of_it;\n}\n\nint g(void)\n{\n" + "\tcount_the_entries_of_the_list();\n" * 6 + "}\n"
    diff = diff.replace(" }\n", "+\t/* the caller holds the lock of the list */\n" * 3 + " }\n").replace("+1,3", "+1,6")
    gems = spark.createDataFrame([(c, "subject", "body", "f.c", "fs", code, diff) for c in ("g1", "g2", "g3")], "commit_hash string, subject string, body string, file_path string, subsystem string, code_before string, diff_hunk string")

    def ask(prompt):
        assert "subject\nbody" in prompt
        return "Return the new value of it, since callers rely on it after the rework of the cache."

    got = model_calls.rewrite_gems(gems, ask, count=2).collect()
    assert len(got) == 2 and all(r.is_synthetic and r.original_instruction == "subject\nbody" and r.instruction.startswith("Return the new value") and r.quality_score == 5.0 for r in got)

    def fail(prompt):
        raise TimeoutError

    assert model_calls.rewrite_gems(gems, fail).isEmpty()


def commit(h, k):
    return json.dumps({"commit_hash": h, "message": f"net: fix leak {k}\n\nbody", "author_name": "A", "author_email": "a@x", "committer_name": "A", "committer_email": "a@x", "author_time": k, "commit_time": k, "parents": ["p"]})


def test_streams_write_each_commit_once(spark, tmp_path):
    columns = "commit_hash string, message string, author_name string, author_email string, committer_name string, committer_email string, author_time long, commit_time long, parents array<string>"
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    before = spark.conf.get(ingest.PROVIDER)
    ingest.large_state(spark)
    try:
        def run():
            ingest.ingest(ingest.raw_stream(spark, str(source), columns, files_per_trigger=1), out, checkpoint).awaitTermination(120)
            return sorted(r.commit_hash for r in spark.read.parquet(f"{out}/commits").collect()), sorted(r.commit_hash for r in spark.read.parquet(f"{out}/tags").collect())

        (source / "a.json").write_text(commit("h1", 1) + "\n" + commit("h2", 2) + "\n" + commit("h2", 2) + "\n")
        (source / "b.json").write_text(commit("h2", 2) + "\n" + commit("h3", 3) + "\n")
        assert run() == (["h1", "h2", "h3"],) * 2
        (source / "c.json").write_text(commit("h1", 1) + "\n" + commit("h4", 4) + "\n")  # a restart: the keys are in the checkpoint
        assert run() == (["h1", "h2", "h3", "h4"],) * 2
        assert run()[0] == ["h1", "h2", "h3", "h4"]
    finally:
        spark.conf.set(ingest.PROVIDER, before)


def test_updates_rewrite_only_files_with_their_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.format_string("k%04d", "id").alias("key"), F.lit(0.0).alias("score"), F.col("id").alias("n"))
    versioned.create(rows, path, "key", files=10)
    with pytest.raises(ValueError):
        versioned.create(rows, path, "key")
    files = {r.file for r in versioned.manifest(spark, path).collect()}
    assert len(files) == 10
    changes = spark.createDataFrame([("k0003", 7.0), ("k0003", 5.0), ("k0004", None), ("k0950", 9.0), ("none", 1.0), (None, 2.0)], "key string, score double")
    touched, total = versioned.update(spark, path, changes, "key")
    assert (touched, total) == (2, 10)
    kept = {r.file for r in versioned.manifest(spark, path).collect()}
    assert len(files & kept) == 8 and versioned.versions(spark, path) == [1, 2]
    now = {r.key: (r.score, r.n) for r in versioned.read(spark, path).collect()}
    assert len(now) == 1000 and now["k0003"] == (5.0, 3) and now["k0004"] == (None, 4) and now["k0950"] == (9.0, 950) and now["k0500"] == (0.0, 500)
    assert versioned.read(spark, path, 1).where("score <> 0 OR score IS NULL").isEmpty() and versioned.read(spark, path, 1).count() == 1000
    assert versioned.update(spark, path, changes.where("key = 'none'"), "key")[0] == 0 and versioned.versions(spark, path) == [1, 2]
    with pytest.raises(ValueError):
        versioned.update(spark, path, changes.withColumnRenamed("score", "unknown"), "key")
    with pytest.raises(Exception, match="(?i)exist"):
        versioned._save(versioned.manifest(spark, path), path, 2)  # a writer that lost the race


def test_pages_read_only_files_that_hold_them(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.create(spark.range(1000).select(F.format_string("k%04d", "id").alias("key"), F.lit(0).alias("v")), path, "key", files=10)
    versioned.update(spark, path, spark.createDataFrame([("k0010", 1), ("k0555", 2), ("k0990", 3)], "key string, v int"), "key")
    seen, after, read = [], None, []
    while True:
        files = versioned.page_files(spark, path, after, 60)
        got = [r.key for r in versioned.page(spark, path, "key", after, 60).collect()]
        if not got:
            break
        read.append(len(files))
        seen += got
        after = got[-1]
    assert seen == [f"k{i:04}" for i in range(1000)] and max(read) <= 5 and sum(read) / len(read) < 4


def test_no_prompt_is_asked_twice(spark, tmp_path):
    """A job that dies in the middle, a second run, repeated prompts, calls that fail and calls that take too long."""
    log, ledger, broken = tmp_path / "asked", str(tmp_path / "ledger"), tmp_path / "broken"
    log.mkdir()
    broken.touch()

    def ask(prompt):
        import os
        import time
        import uuid

        (log / f"{prompt}-{uuid.uuid4().hex}").touch()
        if prompt == "p7":
            raise TimeoutError("never")
        if prompt == "p9":
            time.sleep(3)
        if prompt == "p5" and broken.exists():
            os._exit(1)  # the worker is gone, and with it the task
        return f"reply to {prompt}"

    def counts():
        found = {}
        for f in log.iterdir():
            found[f.name.split("-")[0]] = found.get(f.name.split("-")[0], 0) + 1
        return found

    rows = spark.createDataFrame([(i, f"p{i % 20}") for i in range(60)] + [(99, None)], "n int, prompt string")
    run = lambda: reply_ledger.ask_all(rows, ask, ledger, rounds=5, tasks=2, attempts=2, seconds=1, workers=3)
    with pytest.raises(Exception, match="(?i)worker|crash|exit|EOF"):
        run().collect()
    known = reply_ledger.replies(spark, ledger).count()
    before = counts()
    broken.unlink()
    got = {(r.n, r.prompt): r.reply for r in run().collect()}
    assert len(got) == 61 and got[99, None] is None
    assert all(reply == (None if p in ("p7", "p9") else f"reply to {p}") for (n, p), reply in got.items() if p)
    after = counts()
    held = {f"p{i}" for i in range(20)} - {"p5", "p7", "p9"}
    assert sum(after[p] for p in held) - len(held) <= 6  # only what shared a task with the one that died
    assert 0 <= known < 18 and all(after[p] == before.get(p, 0) or before.get(p, 0) <= 1 for p in held)
    run().collect()
    again = counts()
    assert all(again[p] == after[p] for p in held) and again["p5"] == after["p5"] and again["p7"] == after["p7"] + 2


def test_peeks_are_bytes(spark):
    commits = spark.createDataFrame([("c", "aé𝄞z"), ("d", ""), ("e", None)], "commit_hash string, t string")
    got = {r.commit_hash: (r.t_head, r.t_tail) for r in io.inspect(commits, commits.select("commit_hash"), ["commit_hash"], 5, {"t": (2, 6)}).collect()}
    assert got == {"c": ("a\ufffd", "\ufffd𝄞z"), "d": ("", ""), "e": (None, None)}


def test_strip_is_that_of_python(spark):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    cases = ["", " ", "a", *(f"{b}{b}x{b}y{b}" for b in blanks), "".join(blanks), "\u200b x \u200b", "é\u3000", "x" * 5000 + " " * 50]
    got = {r.s: (r.b, r.r) for r in spark.createDataFrame([(c,) for c in cases], "s string").select("s", text.strip(F.col("s")).alias("b"), text.rstrip(F.col("s")).alias("r")).collect()}
    assert got == {c: (c.strip(), c.rstrip()) for c in cases} and len(blanks) == len(text.BLANKS) == 29


def test_look_ups_skip_row_groups(spark, tmp_path):
    """Eight files whose keys span the same range: statistics can't tell them apart, Bloom filters can."""
    rows = spark.range(80_000).select(F.sha1(F.col("id").cast("string")).alias("commit_hash"), "id").repartition(8, "id")
    wanted = rows.where("id = 4711").first().commit_hash

    def rows_read(path):
        found = io.lookup(spark.read.parquet(path), wanted)
        assert [r.id for r in found.collect()] == [4711]
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        leaf = leaf.executedPlan().collectLeaves().head() if "Adaptive" in leaf.getClass().getSimpleName() else leaf
        return leaf.metrics().get("numOutputRows").get().value()

    io.append(rows, str(tmp_path / "plain"), key="commit_hash")
    io.append(rows, str(tmp_path / "bloom"), key="commit_hash", keys_expected=20_000)
    assert rows_read(str(tmp_path / "bloom")) <= 20_000 < 70_000 < rows_read(str(tmp_path / "plain"))

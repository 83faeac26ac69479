"""Joins and groupings of the history queries move fields; texts are made of the rows that come out."""

import pytest
from pyspark.sql import functions as F

from commitloom.functions import diffs, text
from commitloom.operators import context, late, validate
from commitloom.plans import export, queries

DATA = "/root/testdata/sf0.001"
TEXTS = {"diff_hunk", "code_before", "code_after", "body", "instruction", "input", "output"}


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def moved(df):
    """Sets of columns that go into each join, grouping and sort of the optimised plan."""
    for node in nodes(df._jdf.queryExecution().optimizedPlan()):
        if node.nodeName() in ("Join", "Aggregate", "Sort", "Window"):
            children = node.children()
            for i in range(children.size()):
                output = children.apply(i).output()
                yield {output.apply(j).name() for j in range(output.size())}


@pytest.mark.parametrize("name", ["export_standard", "export_full_code", "export_tags_exclude", "export_batch", "tier_standard", "production_premium", "hub_high_score", "review_set", "explain_set", "security_set", "bugfix_pairs", "reviewer_set", "hub_prep", "prep_premium", "largest_diff", "first_file", "clean_texts", "alpaca_prompts", "scoring_prompts"])
def test_no_text_is_moved(spark, name):
    seen = list(moved(queries.QUERIES[name](spark, DATA)))
    assert seen and not [columns & TEXTS for columns in seen if columns & TEXTS]
    assert not [columns for columns in seen if "text" in columns and "o_orderkey" in columns]  # the documents' join is the last one of the commits


def test_stored_tables_give_the_same(spark):
    """Tables that hold their texts go through the same builders."""
    commits, files = queries._commits(spark, DATA).cache(), queries._files(spark, DATA).cache()
    tagged = queries.score.with_tags(commits)
    same = {"export_batch": export.batch(commits, files, 70), "hub_prep": export.hub_prep(commits, files).drop("system"), "security_set": export.security_set(tagged, files), "first_file": export.first_file(files).select("commit_hash", "file_path", "diff_hunk")}
    for name, got in same.items():
        want = queries.QUERIES[name](spark, DATA)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_best_of_groups(spark):
    rows = spark.range(3000).selectExpr("sha1(string(id)) AS commit_hash", "id % 3 AS g", "CAST(CASE WHEN id % 11 = 0 THEN NULL ELSE id % 5 END AS DOUBLE) AS s")
    got = export.best(rows, [-F.col("s")], F.when(F.col("g") == 0, F.lit(None).cast("long")).when(F.col("g") == 1, 7).otherwise(650), ("g",)).collect()
    every = sorted(rows.collect(), key=lambda r: (r.s is not None, -(r.s or 0), r.commit_hash))
    want = [r for g, n in ((0, None), (1, 7), (2, 650)) for r in [x for x in every if x.g == g][:n]]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_rows_without_a_source_have_no_texts(spark):
    table = late.Table(spark.sql("SELECT 1 AS k, 2 AS n, 'x2' AS t"), "k", ("k", "n"), ("t",), lambda r: r.withColumn("t", F.concat(F.lit("x"), F.coalesce(F.col("n").cast("string"), F.lit("?")))))
    rows = spark.sql("SELECT explode(array(1, 5)) AS k").join(table.carried("t"), "k", "left")
    assert {(r.k, r.t) for r in table.whole(rows, optional=True).collect()} == {(1, "x2"), (5, None)}


def test_strip_takes_off_what_python_does(spark):
    cases = [a + b + c for a in ("", " ", "　\n", "\x85") for b in ("", "a", "a b", "\xe9", "x€", "\U0001f600", "~!", "\x7f") for c in ("", *text.BLANKS, "\n  ")]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate([*cases, None])], "i int, c string")
    got = rows.select("i", text.strip(F.col("c")).alias("s"), text.rstrip(F.col("c")).alias("r"), text.some_text(F.lit("\n"), F.col("c")).alias("some")).orderBy("i").collect()
    assert [(r.s, r.r, r.some) for r in got[:-1]] == [(c.strip(text.BLANKS), c.rstrip(text.BLANKS), bool(c.strip(text.BLANKS))) for c in cases]
    assert got[-1].s is None and got[-1].r is None


def test_long_stages_are_not_interpreted(spark):
    """HotSpot compiles no method of more than 8000 bytes; such stages must run operator by operator."""
    queries.QUERIES["hub_prep"](spark, DATA)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_diffs_are_made_once_to_be_measured(spark):
    files = late.Table(spark.createDataFrame([(1, "x" * n, 0) for n in (49, 50, 51, 4999, 5000, 5001)] + [(1, None, 0)], "k int, diff_hunk string, is_binary int"), "k")
    kept = export.window_of(files, 50, 5000).rows
    assert sorted(len(r.diff_hunk) for r in kept.collect()) == [51, 4999]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("octet_length") == 1


def test_messages_are_lowered_once(spark):
    """A condition on the score is copied into filters, where nothing is made only once unless it is bound."""
    rows = spark.createDataFrame([("x", "Since MERGE branch 'a'", 1), ("fix Typo", "nothing", 1)], "subject string, body string, files_changed int")
    for name in ("signed_off_by", "reviewed_by", "acked_by"):
        rows = rows.withColumn(name, F.array().cast("array<string>"))
    scored = queries.score.with_score(rows.withColumn("fixes_hash", F.lit(None).cast("string"))).where("heuristic_score >= 0")
    plan = scored.select("subject")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(body") == 1 and plan.count("lower(subject") == 1
    one, two = (r.heuristic_score for r in scored.collect())
    weights = queries.config.WEIGHTS
    assert one == weights["base"] + weights["has_rationale"] + weights["optimal_size"] and two == max(0, weights["base"] + weights["trivial_subject"] + weights["optimal_size"])
    reason = queries.validate.invalid_reason(F.concat(F.lit("Some subject that is long enough\n"), F.col("body")), F.rpad(F.lit("a"), 200, "b"), F.rpad(F.lit("diff --git @@ -1 +1 @@"), 200, "+"), True)
    assert rows.select(reason.alias("r")).first().r == "Merge commit detected: 'Merge branch'"


@pytest.mark.parametrize("name", ["largest_diff", "first_file"])
def test_nothing_is_sorted_before_the_shuffle(spark, name):
    """A sort before it holds all file changes of a task, and spills them where there are many."""
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    after, before = plan.split("Exchange hashpartitioning(k", 1)
    assert "SortAggregate" in after and "Sort" not in before.replace("SortMergeJoin", "")


@pytest.mark.parametrize("name", ["clean_texts", "outcomes_premium", "hub_high_score"])
def test_python_functions_get_short_rows(spark, name):
    """All columns of a row wait for the Python function, on disk if memory is short."""
    called = [node for node in nodes(queries.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan()) if node.nodeName() == "ArrowEvalPython"]
    output = [n.children().apply(0).output() for n in called]
    assert called and not [{o.apply(i).name() for i in range(o.size())} & (TEXTS | {"_text", "text"}) for o in output if {o.apply(i).name() for i in range(o.size())} & (TEXTS | {"_text", "text"})]


def test_places_give_the_region(spark):
    code = "\n".join(x for i in range(40) for x in (f"static int fn{i}(void)", "{", f"\tint é{i};", "}", *[""] * 9))
    diffs = [None, "", "x", "@@ -3,1 +3,1 @@", "@@ -3,1 +3,1 @@\n x\n@@ -200,2 +200,2 @@\n@@ -400 +400 @@", "@@ -9000,2 +1 @@", "@@ -1,500 +1,500 @@", "@@ -0,0 +1,2 @@"]
    cases = [(c, d, n) for c in (None, "", "ab\ncd", code) for d in diffs for n in (0, 5, 120, 8000)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, code string, diff string, n int")
    got = rows.withColumn("places", context.changed_places("code", "diff", "n")).select("i", context.region_of(F.coalesce("code", F.lit("")), F.col("places")).alias("r")).collect()
    assert {r.i: r.r for r in got} == {i: context.region(*c) for i, c in enumerate(cases)}


@pytest.mark.parametrize("name", ["outcomes_high_reasoning", "outcomes_premium", "outcomes_standard"])
def test_files_of_unwanted_commits_are_not_moved(spark, name, monkeypatch):
    """Where a tier wants few commits, their keys meet all file changes first; where it wants many, the result is the same."""
    df = queries.QUERIES[name](spark, DATA)
    assert "Join LeftSemi" in df._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)[1]
    monkeypatch.setattr(export, "FEW", 0)
    many = queries.QUERIES[name](spark, DATA)
    assert "Join LeftSemi" not in many._jdf.queryExecution().optimizedPlan().toString() and sorted(map(str, df.collect())) == sorted(map(str, many.collect()))


@pytest.mark.parametrize("name", ["prep_premium", "reviewer_set", "all_tiers"])
def test_files_of_other_commits_are_not_moved(spark, name):
    """Under a limit, file changes meet the keys of the chosen commits before they are brought together."""
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan.split("RepartitionByExpression", 1)[1]


def test_documents_are_read_once_for_scores_and_tags(spark):
    both = lambda c: queries.score.with_tags(queries.score.with_score(c)).select("commit_hash", "heuristic_score", "flags")
    rows = queries.views.commits(spark, DATA, lambda c: queries.score.with_tags(queries.score.with_score(c))).rows
    assert not [columns for columns in moved(rows.select("heuristic_score", "flags")) if "text" in columns]
    want = both(queries.views.view(spark, DATA, "commits"))
    assert sorted(map(str, rows.select(*want.columns).collect())) == sorted(map(str, want.collect())) and not rows.where("body_length <> length(body)").count()


def test_messages_are_read_once_for_all_files_of_a_commit(spark):
    plan = queries.QUERIES["entry_checks"](spark, DATA)._jdf.queryExecution().optimizedPlan()
    joins = [n.children() for n in nodes(plan) if n.nodeName() == "Join"]
    columns = [{o.apply(i).name() for c in range(children.size()) for o in [children.apply(c).output()] for i in range(o.size())} for children in joins]
    assert any("instruction_length" in c and "l_linenumber" in c for c in columns) and not [c for c in columns if "l_linenumber" in c and c & {"_text", "text"}]


def test_sampled_lines_are_made_once(spark):
    lines = [*(f"-old {i % 3} " for i in range(7)), "+", "+++ b", "--- a", " kept", *("+ new" for _ in range(9))]
    cases = [("old 1 new", "\n".join(lines)), ("", "\n".join(lines)), ("new", "+ new\n+x"), ("x", None), (None, "+x"), ("x", ""), ("x", "+")]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, code string, diff string").select("i", validate.sample_coverage(F.col("code"), F.col("diff")).alias("s"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(diff") == 1

    def want(code, diff):
        first = [x[1:].strip() for x in diff.split("\n") if x[:1] in ("+", "-") and x[:3] not in ("+++", "---")][:10]
        found = sum(x != "" and code is not None and x in code for x in first)
        return found, found * 100.0 / len(first) if first else 0.0

    got = {r.i: (r.s.found, r.s.percent) for r in rows.collect()}
    assert got == {i: (None, 0.0) if d is None else want(c, d) for i, (c, d) in enumerate(cases)}


def test_header_range(spark):
    cases = ["", "@@", "@@@", "@@@@", "@@@@@", "a@@ b @@c", "é@@ é @@ @@", "x@@y", "@@ -1 +1 @@ f @@"]
    plain = lambda d: d.split("@@")[1].strip(" ") if len(d.split("@@")) >= 3 else "unknown"
    rows = spark.createDataFrame([(i, c) for i, c in enumerate([*cases, None])], "i int, d string")
    got = [r.r for r in rows.select("i", diffs.header_range(F.col("d")).alias("r")).orderBy("i").collect()]
    assert got == [*map(plain, cases), "unknown"]

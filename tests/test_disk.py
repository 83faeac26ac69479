"""What waits on disk: shuffle files, hashes and texts that joins move."""

from pathlib import Path

from pyspark.sql import functions as F

from commitloom.operators import patience
from commitloom.plans import queries, tree_queries, views
from commitloom.sources import scratch

DATA = "/root/testdata/sf0.001"


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def joined(df):
    """Names and types of the columns that go into each join."""
    for node in nodes(df._jdf.queryExecution().optimizedPlan()):
        if node.nodeName() == "Join":
            for i in range(2):
                output = node.children().apply(i).output()
                yield {(output.apply(j).name(), output.apply(j).dataType().simpleString()) for j in range(output.size())}


def test_hashes_are_not_moved(spark):
    seen = list(joined(queries.QUERIES["tree_changes"](spark, DATA)))
    assert seen and not [columns for columns in seen if ("commit_hash", "string") in columns]
    contents = {(r.code, r.content) for r in views.view(spark, DATA, "contents").collect()}
    assert {(r.blob, r.content) for r in tree_queries._contents(spark, DATA).collect()} == contents
    mine = views.hashed(views.numbered(spark, DATA, "snapshots").groupBy("commit_hash", "path").agg(F.min("blob").alias("blob")), "blob")
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, views.view(spark, DATA, "snapshots").select("commit_hash", "path", "blob").collect()))


def test_written_tables_leave_no_shuffle_files(spark):
    sc = spark.sparkContext
    before = set(sc._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))
    first = scratch.written(spark.range(1000).groupBy((F.col("id") % 10).alias("g")).count(), "first")
    after = set(sc._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))
    assert not [f for f in after - before if "shuffle" in f]
    path = Path(first._written_to.removeprefix("file://"))
    assert path.exists() and scratch.written(first, "second", instead_of=(first,)).count() == 10 and not path.exists()


def test_deltas_texts_are_not_moved_with_changes(spark):
    rows = [("c", "M", "f", "f", "a", "b", None), ("c", "A", None, "g", None, "a", None), ("c", "D", "h", None, "z", None, None), ("c", "R", "i", "j", "a", "a", 100), ("c", "M", "x", "x", "z", "b", None), ("c", "M", "y", "y", "gone", "b", None)]
    changes = spark.createDataFrame(rows, "commit_hash string, status string, old_path string, new_path string, old_blob string, new_blob string, similarity int")
    blobs = spark.createDataFrame([("a", "1\n", False), ("b", "2\n", False), ("z", "3\n", True)], "blob string, content string, binary boolean")
    df = patience.deltas(changes, blobs)
    assert not [columns for columns in joined(df) if {n for n, _ in columns} >= {"commit_hash", "hunks"} or {n for n, _ in columns} >= {"commit_hash", "old_text"}]
    got = {(r.old_path, r.new_path): (r.is_binary, r.patch is None, r.code_before, r.code_after) for r in df.collect()}
    assert got == {("f", "f"): (False, False, "1\n", "2\n"), (None, "g"): (False, False, "", "1\n"), ("h", None): (True, True, None, None), ("i", "j"): (False, False, "1\n", "1\n"), ("x", "x"): (True, True, None, None), ("y", "y"): (False, True, "", "2\n")}


def test_file_changes_meet_documents_where_they_met_commits(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries.QUERIES["clean_texts"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning(_at" in line]
    assert dealt and all("REPARTITION_BY_COL" in line for line in dealt)


def test_messages_are_judged_once_for_all_files_of_a_commit(spark):
    seen = [{n for n, _ in columns} for columns in joined(queries.QUERIES["validation_summary"](spark, DATA))]
    assert any("told" in c for c in seen) and not [c for c in seen if "l_linenumber" in c and c & {"subject", "_text", "text"}]
    cleaned = queries.QUERIES["clean_texts"](spark, DATA)
    want = cleaned.agg(F.count("*"), F.count_if(F.col("reason").isNull()), F.count_if(F.col("reason").isNotNull())).first()
    assert tuple(queries.QUERIES["validation_summary"](spark, DATA).first()) == tuple(want)

"""Queries over raw commits, raw deltas and model answers, and their DuckDB SQL.

The views are made so that the right value of every row is known without the rule under test: the SQL states it case by case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import paths
from ..operators import derive, score
from ..sources import io
from . import export, model_calls, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_KNOWN = ", ".join(f"({i}, '{p.replace('{excluded}', config.EXCLUDED_PREFIXES[0])}', '{e}', '{s}')" for i, (p, e, s) in enumerate(views.PATHS))
_BINARY = ", ".join(f"'{e}'" for e in config.BINARY_EXTENSIONS)
_FIXES = "CASE WHEN k % 6 = 5 THEN NULL WHEN k % 5 = 0 THEN '12ab34cd56' WHEN k % 5 = 1 THEN 'ABCDEF1' END"
_LINES = "CASE k % 5 WHEN 0 THEN concat('Fixes: 12ab34cd56 (\"x\")', chr(10)) WHEN 1 THEN concat('fixes:  ABCDEF1 later', chr(10)) WHEN 2 THEN concat('Fixes: 12345', chr(10)) WHEN 3 THEN concat('  Fixes: 1234567', chr(10)) ELSE '' END"
_BODY = (
    f"CASE WHEN k % 6 = 5 THEN '' ELSE concat('Work of ', clerk, chr(10), {_LINES}, 'Signed-off-by: A <a@x>', chr(10), CASE WHEN k % 2 = 0 THEN concat('Signed-off-by:  B <b@x>', chr(10)) ELSE '' END, "
    "CASE WHEN k % 7 = 0 THEN concat('Reviewed-by: R <r@x> # twice', chr(10)) ELSE '' END, CASE WHEN k % 11 = 0 THEN concat('Acked-by: K <k@x>', chr(10)) ELSE '' END, 'signed-off-by: lower') END"
)
_COMMITS = f"""derived AS (
  SELECT commit_hash, coalesce(nullif(author_name, ''), 'Unknown') AS author_name, coalesce(author_email, '') AS author_email, coalesce(committer_name, 'Unknown') AS committer_name, '' AS committer_email,
         author_time, commit_time, concat('core: change of ', priority) AS subject, {_BODY} AS body, CAST(k % 7 = 0 AS INT) AS is_merge, CAST(CASE k % 7 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END AS INT) AS parent_count, {_FIXES} AS fixes_hash,
         CASE WHEN k % 6 = 5 THEN '' WHEN k % 2 = 0 THEN 'A <a@x>|B <b@x>' ELSE 'A <a@x>' END AS signed_off_by, CASE WHEN k % 6 <> 5 AND k % 7 = 0 THEN 'R <r@x> # twice' ELSE '' END AS reviewed_by, CASE WHEN k % 6 <> 5 AND k % 11 = 0 THEN 'K <k@x>' ELSE '' END AS acked_by
  FROM (SELECT r.*, o_orderstatus AS clerk, o_orderpriority AS priority FROM ({views.oracle('raw_commits')}) r JOIN orders ON k = o_orderkey))"""


def _files_sql(least: int, binary: bool = False, extensions: tuple[str, ...] = ()) -> str:
    """File changes as they should come out; diffs longer than `least` are cut and marked."""
    marked = f"concat(substr(patch, 1, {least}), {_lit(config.TRUNCATED_DIFF)})"
    flag = f"coalesce(is_binary, false) OR lower(ext) IN ({_BINARY})"
    count = lambda sign: f"CAST(len(list_filter(string_split(diff, chr(10)), lambda x: starts_with(x, '{sign}') AND NOT starts_with(x, '{sign * 3}'))) AS INT)"
    chosen = [f"NOT starts_with(path, '{p}')" for p in config.EXCLUDED_PREFIXES] + ([] if binary else [f"NOT ({flag})"])
    if extensions:
        chosen.append("ext IN (" + ", ".join(f"'{e}'" for e in extensions) + ")")
    rows = f"SELECT *, CASE WHEN patch IS NULL THEN '' WHEN length(patch) > {least} THEN {marked} ELSE patch END AS diff FROM ({views.oracle('raw_deltas')}) JOIN (SELECT * FROM (VALUES {_KNOWN}) v(w, path, ext, subsystem)) ON which = w"
    return f"""SELECT commit_hash, path AS file_path, CASE WHEN status IN ('R', 'C') THEN concat('old/', n, '/', path) END AS old_file_path, CASE WHEN status = 'T' THEN 'M' ELSE status END AS change_type, ext AS file_extension, subsystem,
        diff AS diff_hunk, CASE WHEN status = 'A' THEN '' ELSE 'before' END AS code_before, CASE WHEN status = 'D' THEN '' ELSE 'after' END AS code_after, {count('+')} AS lines_added, {count('-')} AS lines_deleted, CAST({flag} AS INT) AS is_binary
      FROM ({rows}) WHERE {' AND '.join(chosen)}"""


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return views.view(spark, sf_dir, "raw_commits"), views.view(spark, sf_dir, "raw_deltas")


def _query(name: str, build: Callable[[DataFrame, DataFrame], DataFrame], sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(*_raw(spark, sf_dir))
    ORACLE_SQL[name] = sql


def _flat(commits: DataFrame) -> DataFrame:
    """Times as seconds and lists as text, which every engine writes alike."""
    times = [F.unix_timestamp(c).alias(t) for c, t in (("author_date", "author_time"), ("commit_date", "commit_time"))]
    lists = [F.array_join(c, "|").alias(c) for c in ("signed_off_by", "reviewed_by", "acked_by")]
    return commits.select("commit_hash", "author_name", "author_email", "committer_name", "committer_email", *times, "subject", "body", "is_merge", "parent_count", "fixes_hash", *lists)


_query("derive_commits", lambda c, d: _flat(derive.commit_rows(c)), f"WITH {_COMMITS} SELECT * FROM derived")
_query("derive_files", lambda c, d: derive.file_rows(d), _files_sql(100_000))
_query("derive_files_cut", lambda c, d: derive.file_rows(d, config.ExtractConfig(max_diff=60)), _files_sql(60))
_query("derive_files_binary", lambda c, d: derive.file_rows(d, config.ExtractConfig(include_binary=True)), _files_sql(100_000, binary=True))
_query("derive_files_code", lambda c, d: derive.file_rows(d, config.ExtractConfig(include_extensions=config.CODE_EXTENSIONS)), _files_sql(100_000, extensions=config.CODE_EXTENSIONS))
_query(
    "commit_totals",
    lambda c, d: derive.with_file_totals(derive.commit_rows(c).select("commit_hash"), derive.file_rows(d)),
    f"SELECT r.commit_hash, coalesce(n, 0) AS files_changed, CAST(coalesce(a, 0) AS BIGINT) AS total_additions, CAST(coalesce(x, 0) AS BIGINT) AS total_deletions FROM ({views.oracle('raw_commits')}) r LEFT JOIN (SELECT commit_hash, count(*) AS n, sum(lines_added) AS a, sum(lines_deleted) AS x FROM ({_files_sql(100_000)}) GROUP BY commit_hash) f ON f.commit_hash = r.commit_hash",
)
_query(
    "storage_rows",
    lambda c, d: derive.for_storage(c.select("commit_hash", F.repeat("message", 30).alias("subject"), F.col("author_name").alias("author"), F.when(F.col("k") % 2 == 0, F.col("parents")).alias("list"), (F.col("k") % 2 == 0).alias("even"), F.lit(None).cast("string").alias("fixes_hash"))).withColumn("list", F.size("list")),
    f"SELECT commit_hash, substr(repeat(message, 30), 1, 1000) AS subject, coalesce(author_name, '') AS author, CAST(CASE WHEN k % 2 = 0 THEN len(parents) ELSE 0 END AS INT) AS list, CAST(k % 2 = 0 AS INT) AS even, CAST(NULL AS VARCHAR) AS fixes_hash FROM ({views.oracle('raw_commits')})",
)
_query(
    "unseen_commits",
    lambda c, d: io.unseen(c.select("commit_hash", "k"), c.where("k % 3 = 0").select("commit_hash")),
    f"SELECT commit_hash, k FROM ({views.oracle('raw_commits')}) WHERE k % 3 <> 0",
)
_query(
    "resumed_commits",
    lambda c, d: io.resume_from(c.select("commit_hash", "k"), "k", "commit_hash", _start(c)),
    f"SELECT commit_hash, k FROM ({views.oracle('raw_commits')}) WHERE k >= (SELECT k FROM ({views.oracle('raw_commits')}) WHERE k % 2 = 0 ORDER BY commit_hash LIMIT 1)",
)
_query(
    "grafted_histories",
    lambda c, d: io.history_union(c.where("k % 2 = 0").select("commit_hash", "parents"), c.where("k % 3 = 0").select("commit_hash", "parents"), grafts=c.where("k % 12 = 0").select("commit_hash", F.array(F.lit("g")).alias("parents"))).select("commit_hash", F.array_join("parents", ",").alias("parents")),
    f"SELECT commit_hash, CASE WHEN k % 12 = 0 THEN 'g' ELSE array_to_string(parents, ',') END AS parents FROM ({views.oracle('raw_commits')}) WHERE k % 2 = 0 OR k % 3 = 0",
)
_query("commit_lookup", lambda c, d: io.lookup(c, _start(c)).select("commit_hash", "message"), f"SELECT commit_hash, message FROM ({views.oracle('raw_commits')}) WHERE k % 2 = 0 ORDER BY commit_hash LIMIT 1")
_query(
    "inspection",
    lambda c, d: io.inspect(c.select("commit_hash", "message"), d.select("commit_hash", "n", "status", "new_path"), ["commit_hash", "n"], 25, {"message": (20, 30)}),
    f"SELECT commit_hash, substr(message, 1, 20) AS message_head, right(message, 30) AS message_tail, n, status, new_path FROM ({views.oracle('raw_commits')}) JOIN ({views.oracle('raw_deltas')}) USING (commit_hash) ORDER BY commit_hash, n LIMIT 25",
)
_query(
    "path_predicates",
    lambda c, d: d.select(F.coalesce("new_path", "old_path").alias("path")).distinct().select("path", paths.is_binary_path(F.col("path")).alias("binary"), paths.is_excluded(F.col("path")).alias("excluded")),
    f"SELECT DISTINCT coalesce(new_path, old_path) AS path, lower(ext) IN ({_BINARY}) AS binary, starts_with(coalesce(new_path, old_path), '{config.EXCLUDED_PREFIXES[0]}') AS excluded FROM ({views.oracle('raw_deltas')}) JOIN (SELECT * FROM (VALUES {_KNOWN}) v(w, path, ext, subsystem)) ON which = w",
)


def _start(c: DataFrame) -> str:
    return c.where("k % 2 = 0").orderBy("commit_hash").select("commit_hash").first()[0]  # one row


#: Replies of a model (reply, score, reason), each with what should be read from it.
_REPLIES = (
    ('{"score": 4, "reason": "clear"}', "4.0", "clear"),
    ('Sure: {"score": "3", "reason": "fine"} ok', "3.0", "fine"),
    ('{"score": 5}', "5.0", ""),
    ('{"score": 9, "reason": "2 of 5"}', "2.0", '{"score": 9, "reason": "2 of 5"}'),
    ("I rate it 4 of 5", "4.0", "I rate it 4 of 5"),
    ("no number", None, None),
    ('{"score": "high", "reason": "1"}', None, None),
    ("", None, None),
)


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.get(F.array(*(F.lit(r) for r, _, _ in _REPLIES)), (F.col("o_orderkey") % len(_REPLIES)).cast("int"))
    value, reason = score.parse_reply(F.col("reply"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", reply.alias("reply")).select("o_orderkey", value.alias("score"), reason.alias("reason"))


_cases = lambda at: " ".join(f"WHEN {i} THEN {'NULL' if r[at] is None else r[at] + '::DOUBLE' if at == 1 else _lit(r[at])}" for i, r in enumerate(_REPLIES))
QUERIES["parse_replies"] = _replies
ORACLE_SQL["parse_replies"] = f"SELECT o_orderkey, CASE o_orderkey % {len(_REPLIES)} {_cases(1)} END AS score, CASE o_orderkey % {len(_REPLIES)} {_cases(2)} END AS reason FROM orders"

_RUBRIC = ("has_diff", "diff_format", "has_context", "addresses_issue", "kernel_style")
_words_sql = "CASE category " + " ".join(f"WHEN '{name}' THEN " + " OR ".join(f"contains(lower(r), {_lit(w.lower())})" for w in words) for name, words in config.CATEGORY_WORDS.items()) + " ELSE false END"
_MARKS = (
    "CAST(contains(r, 'diff --git') OR contains(r, '@@') AS INT) AS has_diff, CAST((contains(r, 'diff --git') OR contains(r, '@@')) AND contains(r, '---') AND contains(r, '+++') AS INT) AS diff_format, "
    f"CAST((length(r) - length(replace(r, chr(10) || ' ', ''))) / 2 > 2 AS INT) AS has_context, CAST({_words_sql} AS INT) AS addresses_issue, "
    "CAST(" + " + ".join(f"CAST(contains(r, {_lit(m) if m != chr(9) else 'chr(9)'}) AS INT)" for m in config.STYLE_MARKS) + " >= 2 AS INT) AS kernel_style"
)
_RATED = "SELECT id, category, {marks} FROM (SELECT id, category, {which} AS r FROM (" + views.oracle("responses") + "))"


def _responses(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    return views.view(spark, sf_dir, "responses").select("id", "category", F.col(which).alias("response"))


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.compare_models(_responses(spark, sf_dir, "base_response"), _responses(spark, sf_dir, "tuned_response"))


QUERIES["response_rubric"] = lambda spark, sf_dir: _responses(spark, sf_dir, "base_response").select("id", "category", score.rubric(F.col("response"), F.col("category")).alias("s")).select("id", "category", "s.*")
ORACLE_SQL["response_rubric"] = _RATED.format(marks=_MARKS, which="base_response")
_total = lambda which: "SELECT id, category, " + " + ".join(_RUBRIC) + " AS n FROM (" + _RATED.format(marks=_MARKS, which=which) + ")"
_COMPARED = f"SELECT id, b.category, b.n AS base_score, t.n AS tuned_score, CASE WHEN t.n > b.n THEN 'tuned' WHEN b.n > t.n THEN 'base' ELSE 'tie' END AS winner FROM ({_total('base_response')}) b JOIN ({_total('tuned_response')}) t USING (id)"
QUERIES["compare_models"] = _compared
ORACLE_SQL["compare_models"] = _COMPARED
QUERIES["model_improvement"] = lambda spark, sf_dir: score.improvement(_compared(spark, sf_dir))
ORACLE_SQL["model_improvement"] = f"SELECT *, CASE WHEN tuned_total > base_total THEN 'tuned' WHEN base_total > tuned_total THEN 'base' ELSE 'tie' END AS winner, CASE WHEN tuned_total > base_total THEN CASE WHEN base_total > 0 THEN (tuned_total - base_total) / base_total::DOUBLE * 100 ELSE 100 END END AS improvement FROM (SELECT CAST(sum(base_score) AS BIGINT) AS base_total, CAST(sum(tuned_score) AS BIGINT) AS tuned_total FROM ({_COMPARED}))"


def stand_in(prompt: str) -> str:
    """A model for tests: it answers by the prompt's length, sometimes in prose, sometimes not at all."""
    n = len(prompt)
    if n % 7 == 0:
        raise TimeoutError("no answer")
    return f"score {n % 5 + 1}" if n % 7 == 1 else f'{{"score": {n % 5 + 1}, "reason": "length {n}"}}'


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits, files = views.commits(spark, sf_dir, score.with_score), views.files(spark, sf_dir)
    return model_calls.score_commits(commits, files, stand_in).select("commit_hash", "ai_quality_score", "ai_score_reason")


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits, files = views.commits(spark, sf_dir, score.with_score), views.files(spark, sf_dir)
    rows = model_calls.scoring_candidates(commits, files, limit=500).where("diff_hunk IS NOT NULL")
    return rows.select("commit_hash", model_calls.scoring_prompt(export.message(), F.col("diff_hunk"), F.col("code_before")).alias("prompt"))


def scoring_sql(prefix: str) -> None:
    """The two queries that need the commit view's score; prefix holds the CTEs of the history queries."""
    a, b, c, d = map(_lit, config.SCORING_PARTS)
    kinds = ", ".join(f"'{e}'" for e in config.CODE_EXTENSIONS)
    prompt = f"{a} || substr(concat(subject, chr(10), chr(10), body), 1, {config.MAX_PROMPT_INSTRUCTION}) || chr(10) || CASE WHEN coalesce(code_before, '') = '' THEN '' ELSE {b} || substr(code_before, 1, {config.INPUT_CUT}) || chr(10) END || {c} || substr(diff_hunk, 1, {config.MAX_OUTPUT}) || {d}"
    first = f"(SELECT * FROM sized WHERE n_bytes > {config.MIN_OUTPUT} AND n_bytes < {config.MAX_OUTPUT} AND file_extension IN ({kinds}) QUALIFY row_number() OVER (PARTITION BY commit_hash ORDER BY file_path) = 1)"
    wanted = "(SELECT * FROM commits WHERE heuristic_score >= 30 AND ai_quality_score IS NULL {limit})"
    top = "ORDER BY heuristic_score DESC, commit_hash LIMIT 500"
    ORACLE_SQL["scoring_prompts"] = prefix + f"SELECT commit_hash, {prompt} AS prompt FROM {wanted.format(limit=top)} JOIN {first} f USING (commit_hash)"
    n = f"length({prompt})"
    asked = f"(SELECT commit_hash, diff_hunk IS NULL AS none, {n} AS n FROM {wanted.format(limit='')} LEFT JOIN {first} f USING (commit_hash))"
    ORACLE_SQL["score_commits"] = prefix + (
        f"SELECT commit_hash, CASE WHEN a.commit_hash IS NULL THEN ai_quality_score WHEN none THEN -1 WHEN n % 7 = 0 THEN 0 ELSE n % 5 + 1 END::DOUBLE AS ai_quality_score, "
        f"CASE WHEN a.commit_hash IS NULL THEN ai_score_reason WHEN none THEN 'no valid diff' WHEN n % 7 = 0 THEN 'scoring failed' WHEN n % 7 = 1 THEN concat('score ', n % 5 + 1) ELSE concat('length ', n) END AS ai_score_reason FROM commits LEFT JOIN {asked} a USING (commit_hash)"
    )
    QUERIES["scoring_prompts"], QUERIES["score_commits"] = _prompts, _scored

"""The queries of the commit-history operators over the derived views, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import diffs, paths
from ..operators import chains, clean, context, derive, late, score, validate
from . import export, raw_queries, reports, tree_queries, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _words(words: tuple[str, ...]) -> str:
    return r"(?i)\b(" + "|".join(words) + r")\b"


def _score_sql() -> str:
    w = config.WEIGHTS
    has = lambda test, name: f"CASE WHEN {test} THEN {w[name]} ELSE 0 END"
    terms = [
        has("len(signed_off_by) > 0", "signed_off"),
        has("len(reviewed_by) > 0", "reviewed_by"),
        has("len(acked_by) > 0", "acked_by"),
        has("coalesce(fixes_hash, '') <> ''", "fixes_tag"),
        has("length(subject) + 1 + length(body) > 200", "long_message"),
        has(f"regexp_matches(body, '{_words(config.RATIONALE_WORDS)}')", "has_rationale"),
        has(f"regexp_matches(subject, '{_words(config.TRIVIAL_WORDS)}')", "trivial_subject"),
        has("coalesce(files_changed, 0) BETWEEN 1 AND 5", "optimal_size"),
        has("coalesce(files_changed, 0) > 20", "too_many_files"),
    ]
    return f"CAST(greatest(0, least(100, {w['base']} + {' + '.join(terms)})) AS DOUBLE)"


def _flags_sql() -> str:
    where = lambda tag: "subject" if tag in config.SUBJECT_TAGS else "concat(subject, chr(10), body)"
    return " + ".join(f"CASE WHEN regexp_matches({where(tag)}, '(?i){pattern}') THEN {bit} ELSE 0 END" for bit, tag, pattern in config.TAG_RULES)


_TAGS_SQL = "list_filter([" + ", ".join(f"CASE WHEN flags & {bit} > 0 THEN '{tag}' END" for bit, tag, _ in config.TAG_RULES) + "], lambda x: x IS NOT NULL)"
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(sql: str) -> str:
    return rf"regexp_replace({sql}, '\A{_BLANK}+|{_BLANK}+\z', '', 'g')"


_MESSAGE = "concat(subject, chr(10), chr(10), body)"
_CLEAN = rf"regexp_replace({_strip(_MESSAGE)}, '[^\S\n]+(\n)|[^\S\n]+\z', '\1', 'g')"
#: The view's code is one function around the changed lines, so all of it is context.
_CONTEXT = "CASE WHEN coalesce(diff_hunk, '') = '' THEN '' ELSE coalesce(code_before, '') END"


def _reason_sql(strict: bool) -> str:
    """The first rule that (instruction, input, output) break."""
    c = config
    rules = [
        (f"length({_strip('instruction')}) < {c.MIN_INSTRUCTION}", f"concat('Instruction too short (', length(instruction), ' < {c.MIN_INSTRUCTION})')"),
        (f"length({_strip('output')}) < {c.MIN_OUTPUT}", f"concat('Output too short (', length(output), ' < {c.MIN_OUTPUT})')"),
        (f"length(output) > {c.MAX_OUTPUT}", f"concat('Output too long (', length(output), ' > {c.MAX_OUTPUT})')"),
        (f"length({_strip('input')}) < {c.MIN_INPUT}", "concat('Input too short or empty (', length(input), ' chars)')"),
    ]
    rules += [(f"contains(lower(instruction), lower('{p}'))", f"concat('Merge commit detected: ', chr(39), '{p}', chr(39))") for p in c.MERGE_PHRASES]
    if strict:
        rules.append(("NOT contains(instruction, chr(10))", "'Instruction has no body (single line)'"))
        rules.append(("NOT ((contains(output, 'diff --git') OR contains(output, '@@ ') OR starts_with(output, '@@')) AND (contains(output, '+') OR contains(output, '-')))", "'Output is not a valid diff format'"))
        rules += [(f"contains(lower(split_part(instruction, chr(10), 1)), '{p}')", f"concat('Trivial change detected: ', chr(39), '{p}', chr(39))") for p in c.TRIVIAL_WORDS]
    return "CASE " + " ".join(f"WHEN {test} THEN {say}" for test, say in rules) + " END"


def _cleaned_sql(source: str, strict: bool) -> str:
    """Rows of source with instruction, input and output cleaned, and the reason."""
    made = f"SELECT *, {_CLEAN} AS instruction, {_CONTEXT} AS input, {_strip('coalesce(diff_hunk, chr(32))')} AS output FROM {source}"
    return f"SELECT *, {_reason_sql(strict)} AS reason FROM ({made})"


def _outcomes_sql(t: config.Tier) -> str:
    outcome = "CASE WHEN coalesce(ai_quality_score <= -1, false) THEN 'skipped_ai_negative' WHEN diff_hunk IS NULL THEN 'skipped_no_diff' WHEN reason IS NOT NULL THEN 'skipped_validation' ELSE 'exported' END"
    source = f"(SELECT c.*, f.* EXCLUDE (commit_hash) FROM commits c LEFT JOIN first_50_8000 f USING (commit_hash) WHERE {_tier_where(t)})"
    return f"SELECT *, {outcome} AS outcome FROM ({_cleaned_sql(source, t.strict)})"


def _production_sql(t: config.Tier) -> str:
    extra = ", ai_quality_score AS _quality_score, ai_score_reason AS _quality_reason" if t.reasoning else ""
    order = ("ai_quality_score DESC, " if t.reasoning else "") + "heuristic_score DESC, commit_hash"
    return f"SELECT commit_hash, subsystem, instruction, input, output, {_lit(config.SYSTEM_PROMPT)} AS system{extra} FROM ({_outcomes_sql(t)}) WHERE outcome = 'exported' ORDER BY {order} LIMIT {t.limit}"


def _hub_sql(t: config.Tier) -> str:
    extra = ", ai_quality_score AS quality_score, ai_score_reason AS quality_reason" if t.reasoning else ""
    kinds = ", ".join(f"'{e}'" for e in config.CODE_EXTENSIONS)
    source = f"(SELECT c.*, f.* EXCLUDE (commit_hash) FROM commits c JOIN sized f USING (commit_hash) WHERE {_tier_where(t)} AND strlen(coalesce(ai_score_reason, '')) > 10 AND NOT coalesce(ai_quality_score <= -1, false) AND n_bytes > {config.MIN_OUTPUT} AND n_bytes < {config.MAX_OUTPUT} AND file_extension IN ({kinds}))"
    return f"SELECT instruction, input, output, commit_hash, file_path, subsystem{extra} FROM ({_cleaned_sql(source, t.strict)}) WHERE reason IS NULL"


_BYTES = "strlen(CAST(to_json(struct_pack(instruction := instruction, input := input, output := output)) AS VARCHAR)) + 1"


def _tier_where(t: config.Tier) -> str:
    terms = [f"heuristic_score >= {t.min_heuristic}"]
    if t.reasoning:
        terms.append("coalesce(ai_score_reason, '') <> ''")
    if t.min_ai is not None:
        terms.append("ai_quality_score > 0" if t.min_ai == 0 else f"ai_quality_score >= {t.min_ai}")
    if t.phrase:
        terms.append(f"contains(ai_score_reason, {_lit(t.phrase)})")
    return " AND ".join(terms)


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


#: What every oracle may refer to; DuckDB evaluates only what it does.
_WITH = (
    f"WITH raw_commits AS ({views.oracle('commits')}), files AS ({views.oracle('files')}),\n"
    f"commits AS (SELECT *, {_score_sql()} AS heuristic_score FROM raw_commits),\n"
    f"flagged AS (SELECT commit_hash, CAST({_flags_sql()} AS INT) AS flags FROM commits),\n"
    f"tags AS (SELECT commit_hash, flags, {_TAGS_SQL} AS tags FROM flagged WHERE flags > 0),\n"
    "fix_edges AS (SELECT c.commit_hash AS fix_commit, c.fixes_hash AS buggy_commit, c.subject AS fix_subject, c.body AS fix_body, 'fixes' AS chain_type FROM commits c WHERE c.fixes_hash IN (SELECT commit_hash FROM commits)),\n"
    "revert_edges AS (SELECT commit_hash AS fix_commit, regexp_extract(body, 'This reverts commit ([0-9a-fA-F]{12,40})', 1) AS buggy_commit, subject AS fix_subject, body AS fix_body, 'revert' AS chain_type FROM commits WHERE starts_with(subject, 'Revert \"') AND regexp_extract(body, 'This reverts commit ([0-9a-fA-F]{12,40})', 1) <> ''),\n"
    "sized AS (SELECT *, strlen(diff_hunk) AS n_bytes FROM files WHERE is_binary = 0),\n"
    "first_50_5000 AS (SELECT * FROM sized WHERE n_bytes > 50 AND n_bytes < 5000 QUALIFY row_number() OVER (PARTITION BY commit_hash ORDER BY file_path) = 1),\n"
    "first_50_8000 AS (SELECT * FROM sized WHERE n_bytes > 50 AND n_bytes < 8000 QUALIFY row_number() OVER (PARTITION BY commit_hash ORDER BY file_path) = 1)\n"
)


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.with_score(views.view(spark, sf_dir, "commits"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, "files")


def _query(name: str, build: Callable[[DataFrame, DataFrame], DataFrame], sql: str | None = None) -> None:
    """build takes (commits, files), both views."""
    QUERIES[name] = lambda spark, sf_dir: build(_commits(spark, sf_dir), _files(spark, sf_dir))
    if sql:
        ORACLE_SQL[name] = _WITH + sql


def _late(name: str, build: Callable[[late.Table, late.Table], DataFrame], sql: str, tags: bool = False, scored: bool = True) -> None:
    """build takes (commits, files), both views with late columns; commits with tags if asked for, and with scores unless told not to."""
    more = (lambda c: score.with_tags(score.with_score(c))) if tags else score.with_score if scored else lambda c: c
    QUERIES[name] = lambda spark, sf_dir: build(views.commits(spark, sf_dir, more, facts=scored), views.files(spark, sf_dir))
    ORACLE_SQL[name] = _WITH + sql


def _cols(*names: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.select(*names)


# Scores, tags, authors and chains.
_query("heuristic_score", lambda c, f: c.select("commit_hash", "heuristic_score"), "SELECT commit_hash, heuristic_score FROM commits")
_query(
    "heuristic_backfill",
    lambda c, f: score.with_score(c.withColumn("heuristic_score", F.when(F.col("k") % 2 == 0, 0.0).otherwise(1.0)), only_missing=True).select("commit_hash", "heuristic_score"),
    "SELECT commit_hash, CASE WHEN k % 2 = 0 THEN heuristic_score ELSE 1.0::DOUBLE END AS heuristic_score FROM commits",
)
_query("classify_commits", lambda c, f: score.commit_tags(c).select("commit_hash", "flags", F.array_join("tags", ",").alias("tags")), "SELECT commit_hash, flags, array_to_string(tags, ',') AS tags FROM tags")
_query("tag_counts", lambda c, f: reports.top_values(score.commit_tags(c).select(F.explode("tags").alias("tag")), "tag", 20), "SELECT tag, count(*) AS entries FROM (SELECT unnest(tags) AS tag FROM tags) GROUP BY tag ORDER BY entries DESC, tag LIMIT 20")
_MAINTAINER = "CASE lower(author_email) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in config.MAINTAINERS.items()) + " END"
_EXPERTISE = f"""SELECT author_email, CAST(count(*) AS INT) AS commit_count, min(author_date) AS first_commit, max(author_date) AS last_commit,
              round(least(50.0::DOUBLE, log10(count(*) + 1) * 20) + least(30.0::DOUBLE, floor(date_diff('second', min(author_date), max(author_date)) / 86400) / 365 * 3) + coalesce(any_value({_MAINTAINER}) * 0.2::DOUBLE, 0), 2) AS expertise_score,
              CAST(any_value({_MAINTAINER}) IS NOT NULL AS INT) AS is_maintainer
       FROM commits GROUP BY author_email HAVING count(*) > 1"""
_query("author_expertise", lambda c, f: score.author_expertise(c).select("author_email", "commit_count", "first_commit", "last_commit", "expertise_score", "is_maintainer"), _EXPERTISE)
_query("top_authors", lambda c, f: reports.top_authors(score.author_expertise(c)).select("author_email", "commit_count", "expertise_score"), f"SELECT author_email, commit_count, expertise_score FROM ({_EXPERTISE}) ORDER BY expertise_score DESC, author_email LIMIT 10")
_query("fix_chains", lambda c, f: chains.fix_edges(c), "SELECT * FROM fix_edges")
_query("revert_chains", lambda c, f: chains.revert_edges(c), "SELECT * FROM revert_edges")
_query("commit_chains", lambda c, f: chains.chains(c), "SELECT * FROM fix_edges UNION ALL SELECT * FROM revert_edges")

# Exports.
_STANDARD = (
    "SELECT c.commit_hash, file_path, subsystem, lines_added + lines_deleted AS lines_changed, {message} AS instruction, code_before AS input, {output} AS output "
    "FROM files f JOIN commits c USING (commit_hash) LEFT JOIN tags t USING (commit_hash) "
    "WHERE is_binary = 0 AND strlen(diff_hunk) > 10 AND lines_added + lines_deleted BETWEEN 5 AND 500 AND is_merge = 0 AND {output} <> '' AND {where}"
)


def _export(name: str, cfg: config.ExportConfig, where: str = "true", output: str = "diff_hunk") -> None:
    columns = ("commit_hash", "file_path", "subsystem", "lines_changed", "instruction", "input", "output")
    _late(name, lambda c, f: export.standard(c, f, cfg).select(*columns), _STANDARD.format(message=_strip(_MESSAGE), output=output, where=where), tags=bool(cfg.include_tags or cfg.exclude_tags))


_plain = config.ExportConfig()
_export("export_standard", _plain)
_export("export_full_code", replace(_plain, full_code=True), output="code_after")
_export("export_by_subsystem", replace(_plain, include_subsystems=("mm", "drivers/net")), "subsystem IN ('mm', 'drivers/net')")
_export("export_without_subsystem", replace(_plain, exclude_subsystems=("mm",)), "subsystem <> 'mm'")
_export("export_tags_include", replace(_plain, include_tags=("security",)), "list_contains(tags, 'security')")
_export("export_tags_exclude", replace(_plain, exclude_tags=("driver", "backport")), "NOT coalesce(list_contains(tags, 'driver') OR list_contains(tags, 'backport'), false)")
_export("export_min_scores", replace(_plain, min_heuristic=70, min_ai=4), "heuristic_score >= 70 AND ai_quality_score >= 4")
_export("export_sample", replace(_plain, sample=0.1), "CAST('0x' || substr(sha1(concat(commit_hash, '|', file_path, '|42')), 1, 8) AS BIGINT) / 4294967296.0 < 0.1")


_late(
    "export_batch",
    lambda c, f: export.batch(c, f, 70),
    f"SELECT commit_hash, heuristic_score, {_strip(_MESSAGE)} AS instruction, substr(code_before, 1, 2000) AS input, diff_hunk AS output FROM commits JOIN first_50_5000 USING (commit_hash) WHERE heuristic_score >= 70",
)
def _all_tiers_sql(tiers: tuple[config.Tier, ...]) -> str:
    one = "SELECT '{name}' AS tier, * FROM (SELECT commit_hash, heuristic_score, ai_quality_score, {instruction} AS instruction, substr(code_before, 1, 2000) AS input, diff_hunk AS output FROM commits JOIN first_50_5000 USING (commit_hash) WHERE {where} ORDER BY {order} LIMIT {limit})"
    return " UNION ALL ".join(one.format(name=t.name, instruction=_strip(_MESSAGE), where=_tier_where(t), order=("ai_quality_score DESC, " if t.reasoning else "") + "heuristic_score DESC, commit_hash", limit=t.limit) for t in tiers)


_LIMITED = tuple(replace(t, limit=n) for t, n in zip(config.TIERS, (50, 400, 700, 60, 80), strict=True))
_late("all_tiers", lambda c, f: export.all_tiers(c, f), _all_tiers_sql(config.TIERS))
_late("all_tiers_limited", lambda c, f: export.all_tiers(c, f, _LIMITED), _all_tiers_sql(_LIMITED))
for _t in config.TIERS:
    _order = ("ai_quality_score DESC, " if _t.reasoning else "") + "heuristic_score DESC, commit_hash"
    _late(
        f"tier_{_t.name}",
        lambda c, f, t=_t: export.tier(c, f, t),
        f"SELECT commit_hash, heuristic_score, ai_quality_score, {_strip(_MESSAGE)} AS instruction, substr(code_before, 1, 2000) AS input, diff_hunk AS output FROM commits JOIN first_50_5000 USING (commit_hash) WHERE {_tier_where(_t)} ORDER BY {_order} LIMIT {_t.limit}",
    )
    _late(f"production_{_t.name}", lambda c, f, t=_t: export.production_tier(c, f, t), _production_sql(_t))
    _late(
        f"outcomes_{_t.name}",
        lambda c, f, t=_t: export.outcome_counts(export.production_outcomes(c, f, t)),
        f"SELECT outcome, count(*) AS commits, CAST(coalesce(sum(CASE WHEN outcome = 'exported' THEN {_BYTES} END), 0) AS BIGINT) AS bytes FROM ({_outcomes_sql(_t)}) GROUP BY outcome",
    )
for _t in config.HUB_TIERS:
    _late(f"hub_{_t.name}", lambda c, f, t=_t: export.hub_tier(c, f, t), _hub_sql(_t))
_late(
    "hub_subsystems",
    lambda c, f: export.subsystem_counts(export.hub_tier(c, f, config.HUB_TIERS[2])),
    f"SELECT subsystem, count(*) AS records, CAST(sum({_BYTES}) AS BIGINT) AS bytes FROM ({_hub_sql(config.HUB_TIERS[2])}) GROUP BY subsystem",
)

_JOINED = "FROM sized f JOIN commits c USING (commit_hash) LEFT JOIN tags t USING (commit_hash)"
_r, _s, _b, _o, _e = (config.TEMPLATES[k] for k in ("review", "security", "bugfix", "optimize", "explain"))
_late(
    "review_set",
    lambda c, f: export.review_set(c, f),
    f"SELECT {_lit(_r[0])} AS system, {_lit(_r[1])} || substr(diff_hunk, 1, 4000) AS instruction, {_lit(_r[2])} || subject || ''':' || chr(10) || chr(10) || body AS output, commit_hash AS _commit_hash {_JOINED} "
    "WHERE n_bytes > 50 AND heuristic_score >= 50 AND NOT coalesce(list_contains(tags, 'backport') OR list_contains(tags, 'documentation'), false)",
    tags=True,
)
_late(
    "security_set",
    lambda c, f: export.security_set(c, f),
    f"SELECT {_lit(_s[0])} AS system, {_lit(_s[1])} || substr(code_before, 1, 4000) AS instruction, {_lit(_s[2])} || substr(diff_hunk, 1, 4000) || chr(10) || chr(10) || 'Explanation: ' || body AS output, commit_hash AS _commit_hash {_JOINED} "
    "WHERE strlen(code_before) > 50 AND list_contains(tags, 'security')",
    tags=True,
)
_late(
    "optimize_set",
    lambda c, f: export.optimize_set(c, f),
    f"SELECT {_lit(_o[0])} AS system, {_lit(_o[1])} || substr(code_before, 1, 4000) AS instruction, substr(code_after, 1, 4000) AS output, commit_hash AS _commit_hash {_JOINED} "
    "WHERE strlen(code_before) > 50 AND strlen(code_after) > 50 AND list_contains(tags, 'performance')",
    tags=True,
)
_late(
    "explain_set",
    lambda c, f: export.explain_set(c, f),
    f"SELECT {_lit(_e[0])} AS system, {_lit(_e[1])} || substr(diff_hunk, 1, 4000) AS instruction, {_MESSAGE} AS output, commit_hash AS _commit_hash {_JOINED} WHERE n_bytes > 50 AND heuristic_score >= 50",
)


def _by_name(f: late.Table) -> late.Table:
    """Paths shared between commits: the part's own path without the order's numbers."""
    return replace(f, rows=f.rows.withColumn("file_path", F.concat("subsystem", F.lit("/shared"), "file_extension")))


_late(
    "bugfix_pairs",
    lambda c, f: export.bugfix_pairs(c, _by_name(f)).select("system", "instruction", "output", "_buggy_commit", "_fix_commit", "_explanation"),
    f"SELECT {_lit(_b[0])} AS system, {_lit(_b[1])} || substr(b.code_after, 1, 4000) AS instruction, substr(x.code_after, 1, 4000) AS output, buggy_commit AS _buggy_commit, fix_commit AS _fix_commit, fix_subject || chr(10) || fix_body AS _explanation "
    "FROM fix_edges e JOIN files b ON b.commit_hash = buggy_commit JOIN files x ON x.commit_hash = fix_commit AND x.subsystem = b.subsystem AND x.file_extension = b.file_extension WHERE strlen(b.code_after) > 50 AND strlen(x.code_after) > 50",
)
_a, _m, _z = map(_lit, config.REVIEWER_PARTS)
_late(
    "reviewer_set",
    lambda c, f: export.reviewer_set(c, f),
    f"SELECT {_lit(config.REVIEWER_SYSTEM)} AS system, {_a} || substr({_strip(_MESSAGE)}, 1, {config.MAX_PROMPT_INSTRUCTION}) || {_m} || substr(diff_hunk, 1, {config.MAX_OUTPUT}) || {_z} AS instruction, "
    "concat('{\"score\": ', CAST(ai_quality_score AS INT), ', \"reason\": ', CAST(to_json(ai_score_reason) AS VARCHAR), '}') AS output, commit_hash AS _commit_hash "
    "FROM (SELECT * FROM commits WHERE ai_quality_score >= 4 AND strlen(coalesce(ai_score_reason, '')) > 20 ORDER BY ai_quality_score DESC, commit_hash LIMIT 2000) "
    "JOIN (SELECT commit_hash, arg_min(diff_hunk, file_path) AS diff_hunk FROM files WHERE strlen(diff_hunk) > 100 AND strlen(diff_hunk) < 8000 GROUP BY commit_hash) USING (commit_hash)",
)
_PREP = (
    "SELECT commit_hash, {strip} AS instruction, substr(code_before, 1, 8000) AS input, substr(diff_hunk, 1, 12000) AS output, CASE WHEN ai_quality_score <> 0 AND ai_score_reason <> '' THEN ai_quality_score END AS _quality_score, "
    "CASE WHEN ai_quality_score <> 0 AND ai_score_reason <> '' THEN ai_score_reason END AS _quality_reason FROM ({commits}) JOIN first_50_5000 USING (commit_hash)"
)
_late("hub_prep", lambda c, f: export.hub_prep(c, f).drop("system"), _PREP.format(strip=_strip(_MESSAGE), commits="SELECT * FROM commits"))
for _t in config.PREP_TIERS:
    _chosen = f"heuristic_score >= {_t.min_heuristic}" + (f" AND ai_quality_score >= {_t.min_ai} AND strlen(coalesce(ai_score_reason, '')) > 10" if _t.reasoning else "")
    _order = ("ai_quality_score DESC, " if _t.reasoning else "") + "heuristic_score DESC, commit_hash"
    _late(f"prep_{_t.name}", lambda c, f, t=_t: export.hub_prep(c, f, t).drop("system"), _PREP.format(strip=_strip(_MESSAGE), commits=f"SELECT * FROM commits WHERE {_chosen} ORDER BY {_order} LIMIT {_t.limit}"))
_query(
    "hub_split",
    lambda c, f: export.split(c.select("commit_hash"), "commit_hash"),
    "SELECT commit_hash, CASE WHEN row_number() OVER (ORDER BY sha1(concat(commit_hash, '|42')), commit_hash) <= floor((SELECT count(*) FROM commits) * 0.1) THEN 'val' ELSE 'train' END AS split FROM commits",
)
_query(
    "hidden_gems",
    lambda c, f: export.hidden_gems(c, f),
    """SELECT commit_hash, subject, body, file_path, subsystem, code_before, diff_hunk
       FROM (SELECT * FROM commits WHERE files_changed BETWEEN 1 AND 5 AND strlen(body) < 150 AND (ai_quality_score IS NULL OR ai_quality_score < 4) ORDER BY sha1(concat(commit_hash, '|42')), commit_hash LIMIT 100)
       JOIN (SELECT * FROM files WHERE file_extension IN ('.c', '.h') QUALIFY row_number() OVER (PARTITION BY commit_hash ORDER BY strlen(diff_hunk) DESC, file_path) = 1) USING (commit_hash) WHERE length(diff_hunk) BETWEEN 100 AND 8000""",
)
_late("largest_diff", lambda c, f: export.largest_diff(f).select("commit_hash", "file_path", "diff_hunk"), "SELECT commit_hash, file_path, diff_hunk FROM files QUALIFY row_number() OVER (PARTITION BY commit_hash ORDER BY strlen(diff_hunk) DESC, file_path) = 1")
_late("first_file", lambda c, f: export.first_file(f).select("commit_hash", "file_path", "diff_hunk"), "SELECT commit_hash, min(file_path) AS file_path, arg_min(diff_hunk, file_path) AS diff_hunk FROM files GROUP BY commit_hash")

# Reports.
_query(
    "commit_counts",
    lambda c, f: reports.commit_counts(c),
    """SELECT count(*) AS total, count_if(is_merge = 0) AS non_merge, count_if(heuristic_score > 0) AS scored, count_if(heuristic_score = 0) AS unscored, count_if(ai_quality_score BETWEEN 1 AND 5) AS ai_scored,
              count_if(ai_quality_score = -1) AS ai_skipped, count_if(ai_quality_score IS NULL AND heuristic_score >= 30) AS ai_pending, count_if(coalesce(ai_score_reason, '') <> '') AS with_reason,
              count_if(heuristic_score >= 90) AS tier_90, count_if(heuristic_score >= 70) AS tier_70, count_if(heuristic_score >= 50) AS tier_50, count_if(strlen(body) < 150) AS short_body,
              count_if(files_changed BETWEEN 1 AND 5) AS few_files, count_if(coalesce(fixes_hash, '') <> '') AS has_fixes, count_if(starts_with(subject, 'Revert "')) AS is_revert FROM commits""",
)
_query("top_subsystems", lambda c, f: reports.top_subsystems(f), "SELECT subsystem, count(*) AS changes FROM files GROUP BY subsystem ORDER BY changes DESC, subsystem LIMIT 20")
_query(
    "line_histogram",
    lambda c, f: reports.line_histogram(f),
    "SELECT CASE WHEN n < 10 THEN '0-10' WHEN n < 50 THEN '10-50' WHEN n < 100 THEN '50-100' WHEN n < 500 THEN '100-500' ELSE '500+' END AS bucket, count(*) AS changes FROM (SELECT lines_added + lines_deleted AS n FROM files) GROUP BY bucket",
)
_query("files_per_commit", lambda c, f: reports.files_per_commit(c, f), "SELECT commit_hash, subject, files FROM commits JOIN (SELECT commit_hash, count(*) AS files FROM files GROUP BY commit_hash) USING (commit_hash) WHERE heuristic_score >= 90 ORDER BY files DESC, commit_hash LIMIT 20")
_query("average_files", lambda c, f: reports.average_files(c, f), "SELECT avg(n) AS average_files FROM (SELECT count(*) AS n FROM files WHERE commit_hash IN (SELECT commit_hash FROM commits WHERE heuristic_score >= 90) GROUP BY commit_hash)")
_query("model_scores", lambda c, f: reports.model_scores(c), "SELECT ai_quality_score, count(*) AS commits FROM commits GROUP BY ai_quality_score")
_query("score_distribution", lambda c, f: reports.score_distribution(c), "SELECT heuristic_score, count(*) AS commits, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM commits) AS percent FROM commits GROUP BY heuristic_score ORDER BY commits DESC, heuristic_score LIMIT 20")
_query(
    "score_ranges",
    lambda c, f: reports.score_ranges(c),
    "SELECT min(heuristic_score) AS least, max(heuristic_score) AS most, avg(heuristic_score) AS average, min(m) AS ai_least, max(m) AS ai_most, avg(m) AS ai_average FROM (SELECT heuristic_score, CASE WHEN ai_quality_score BETWEEN 1 AND 5 THEN ai_quality_score END AS m FROM commits)",
)
_query(
    "best_reviews",
    lambda c, f: reports.best_reviews(c),
    "SELECT substr(commit_hash, 1, 12) AS short_hash, substr(subject, 1, 60) AS short_subject, ai_quality_score, repeat('*', CAST(ai_quality_score AS INT)) || repeat('-', 5 - CAST(ai_quality_score AS INT)) AS stars FROM commits WHERE ai_quality_score BETWEEN 1 AND 5 ORDER BY ai_quality_score DESC, heuristic_score DESC, commit_hash LIMIT 15",
)
_query(
    "agreement",
    lambda c, f: c.groupBy(score.agreement(F.col("heuristic_score"), F.col("ai_quality_score")).alias("verdict")).agg(F.count("*").alias("commits")),
    "SELECT CASE WHEN gap < 1 THEN 'agree' WHEN gap < 2 THEN 'close' WHEN gap IS NOT NULL THEN 'differ' END AS verdict, count(*) AS commits FROM (SELECT abs(ai_quality_score - heuristic_score / 100 * 5) AS gap FROM commits) GROUP BY verdict",
)

# Derivations.
_query("path_attributes", lambda c, f: f.select("commit_hash", "file_path", paths.extension(F.col("file_path")).alias("extension"), paths.subsystem(F.col("file_path")).alias("derived")),
       "SELECT commit_hash, file_path, CASE WHEN contains(file_path, '.') THEN '.' || split_part(file_path, '.', -1) ELSE '' END AS extension, subsystem AS derived FROM files")
_query("diff_line_counts", lambda c, f: f.select("commit_hash", "file_path", diffs.lines_added(F.col("diff_hunk")).alias("added"), diffs.lines_deleted(F.col("diff_hunk")).alias("deleted")), "SELECT commit_hash, file_path, lines_added AS added, lines_deleted AS deleted FROM files")
_query("hunk_ranges", lambda c, f: f.select("commit_hash", "file_path", F.explode(diffs.hunks(F.col("diff_hunk"))).alias("h")).select("commit_hash", "file_path", "h.*"), "SELECT commit_hash, file_path, 3::INT AS start, CAST(lines_deleted + 1 AS INT) AS count, CAST(lines_deleted + 3 AS INT) AS \"end\" FROM files")
_query(
    "trailers",
    lambda c, f: _with_message(c).select("commit_hash", derive.fixes_hash(F.col("message")).alias("fixes"), F.array_join(derive.trailers(F.col("message"), "Signed-off-by"), ",").alias("signed")),
    "SELECT commit_hash, CASE WHEN length(fixes_hash) >= 7 THEN fixes_hash END AS fixes, array_to_string(signed_off_by, ',') AS signed FROM commits",
)


def _with_message(c: DataFrame) -> DataFrame:
    signed = F.array_join(F.transform("signed_off_by", lambda x: F.concat(F.lit("Signed-off-by: "), x)), "\n")
    fixes = F.when(F.col("fixes_hash").isNotNull(), F.concat(F.lit("Fixes: "), F.col("fixes_hash"), F.lit(' ("x")\n'))).otherwise("")
    return c.withColumn("message", F.concat("subject", F.lit("\n\n"), "body", F.lit("\n"), fixes, signed))


_query(
    "merge_ranges",
    lambda c, f: context.merge_ranges(f.select("subsystem", F.col("lines_added").alias("first"), (F.col("lines_added") + F.col("lines_deleted")).alias("last")).distinct(), "subsystem", gap=0),
    """SELECT subsystem, min(a) AS first, max(b) AS last FROM (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY subsystem ORDER BY a, b) AS island FROM (
         SELECT *, max(b) OVER (PARTITION BY subsystem ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (
           SELECT DISTINCT subsystem, lines_added AS a, lines_added + lines_deleted AS b FROM files))) GROUP BY subsystem, island""",
)

# Cleaning and validation.
_ALL = _cleaned_sql("(SELECT c.*, f.* EXCLUDE (commit_hash) FROM commits c JOIN files f USING (commit_hash))", True)
_late("clean_texts", lambda c, f: export.all_cleaned(c, f, True).select("commit_hash", "file_path", "instruction", "input", "output", "reason"), f"SELECT commit_hash, file_path, instruction, input, output, reason FROM ({_ALL})", scored=False)
_late("validation_summary", lambda c, f: validate.summary(export.all_valid(c, f, True)), f"SELECT count(*) AS total, count_if(reason IS NULL) AS valid, count_if(reason IS NOT NULL) AS invalid FROM ({_ALL})", scored=False)
_query("clean_instruction", lambda c, f: c.select("commit_hash", clean.instruction(F.concat("subject", F.lit("\n\n"), "body")).alias("instruction")),
       f"SELECT commit_hash, {_CLEAN} AS instruction FROM commits")
_HAVE = f"list_distinct(list_filter(list_transform(string_split(code_before, chr(10)), lambda x: {_strip('x')}), lambda x: x <> ''))"
_HEADERS = " OR ".join(f"starts_with(x, '{h}')" for h in ("diff ", "index ", "---", "+++", "@@", "+"))
_WANTED = f"list_distinct(list_filter(list_transform(list_filter(string_split(diff_hunk, chr(10)), lambda x: NOT ({_HEADERS})), lambda x: {_strip("CASE WHEN starts_with(x, '-') THEN substr(x, 2) ELSE x END")}), lambda x: x <> ''))"
_CHANGED = f"list_transform(list_filter(string_split(diff_hunk, chr(10)), lambda x: (starts_with(x, '+') AND NOT starts_with(x, '+++')) OR (starts_with(x, '-') AND NOT starts_with(x, '---'))), lambda x: {_strip('substr(x, 2)')})"
_SQUEEZED = lambda x: _strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")
_COVERED = "SELECT commit_hash, file_path, CAST(len(wanted) AS INT) AS total, CAST(len(wanted) - len(missing) AS INT) AS found, CASE WHEN len(wanted) = 0 THEN 0 ELSE (len(wanted) - len(missing)) * 100.0::DOUBLE / len(wanted) END AS percent FROM "
_near = f"len(list_filter(loose, lambda i: contains(i, {_SQUEEZED('c')}) OR contains({_SQUEEZED('c')}, i))) > 0"
_SMART = _COVERED + f"(SELECT *, list_filter(wanted, lambda c: NOT (list_contains(have, c) OR {_near})) AS missing FROM (SELECT *, list_transform(have, lambda x: {_SQUEEZED('x')}) AS loose FROM (SELECT commit_hash, file_path, {_WANTED} AS wanted, {_HAVE} AS have FROM files)))"
_LOOSE = _COVERED + f"(SELECT *, list_filter(wanted, lambda c: len(list_filter(have, lambda i: contains(i, c) OR contains(c, i))) = 0) AS missing FROM (SELECT commit_hash, file_path, list_distinct(list_filter({_CHANGED}, lambda x: x <> '')) AS wanted, {_HAVE} AS have FROM files))"
_query("coverage_smart", lambda c, f: f.select("commit_hash", "file_path", validate.smart_coverage(F.col("code_before"), F.col("diff_hunk")).alias("s")).select("commit_hash", "file_path", "s.total", "s.found", "s.percent"), _SMART)
_query("coverage_changed", lambda c, f: f.select("commit_hash", "file_path", validate.changed_coverage(F.col("code_before"), F.col("diff_hunk")).alias("s")).select("commit_hash", "file_path", "s.total", "s.found", "s.percent"), _LOOSE)
_query(
    "coverage_totals",
    lambda c, f: validate.coverage_summary(f.select(validate.smart_coverage(F.col("code_before"), F.col("diff_hunk"))["percent"].alias("percent"))),
    f"SELECT count(*) AS entries, avg(percent) AS average, count_if(percent >= 90) AS at_90, count_if(percent >= 75 AND percent < 90) AS at_75, count_if(percent >= 50 AND percent < 75) AS at_50, count_if(percent < 50) AS below_50, count_if(percent >= 80) AS at_80 FROM ({_SMART})",
)
_STANDARD_ROWS = _STANDARD.format(message=_strip(_MESSAGE), output="diff_hunk", where="true")
_FILLED = {c: f"length({_strip(f'coalesce({c}, chr(32))')}) > 0" for c in ("instruction", "input", "output")}
_share = lambda c: f"CASE WHEN total = 0 THEN 0 ELSE {c} * 100.0::DOUBLE / total END"
_late(
    "quality_report",
    lambda c, f: validate.quality_report(export.records(export.standard(c, f))),
    f"SELECT *, CASE WHEN valid_percent >= 99 THEN 'excellent' WHEN valid_percent >= 95 THEN 'good' ELSE 'poor' END AS validity_grade, CASE WHEN empty_percent <= 1 THEN 'excellent' WHEN empty_percent <= 5 THEN 'good' ELSE 'poor' END AS completeness_grade FROM ("
    f"SELECT *, {_share('valid')} AS valid_percent, {_share('empty_input')} AS empty_percent FROM (SELECT count(*) AS total, count_if({_FILLED['instruction']} AND {_FILLED['output']}) AS valid, count_if(NOT ({_FILLED['input']})) AS empty_input, "
    + ", ".join(f"{f}(length({c})){'::DOUBLE' if f == 'avg' else '::INT'} AS {f}_{c}" for c in ("instruction", "input", "output") for f in ("min", "max", "avg"))
    + f", sum(length(instruction) + length(input) + length(output)) / 4::DOUBLE AS estimated_tokens FROM ({_STANDARD_ROWS})))",
)
_late(
    "entry_checks",
    lambda c, f: export.standard_entries(c, f).select(
        "commit_hash", "file_path", "has_instruction", "instruction_length", "has_input", "input_length", "has_output", "output_length", validate.is_truncated(F.col("input"), F.col("output")).alias("truncated"),
        validate.looks_like_code(F.col("input")).alias("code"), validate.same_start(F.col("input"), F.col("output"), 7).alias("same"), validate.sample_coverage(F.col("input"), F.col("output"))["verdict"].alias("verdict"),
        diffs.header_range(F.col("output")).alias("range"), diffs.header_function(F.col("output")).alias("function"),
    ),
    f"SELECT commit_hash, file_path, {', '.join(f'{t} AS has_{c}, CAST(length({c}) AS INT) AS {c}_length' for c, t in _FILLED.items())}, length(input) >= 7999 OR length(output) >= 11999 AS truncated, "
    "(contains(input, 'static') OR contains(input, 'int ') OR contains(input, 'void ')) AND contains(input, '{') AND contains(input, '}') AS code, substr(input, 1, 7) = substr(output, 1, 7) AS same, "
    f"CASE WHEN share >= 80 THEN 'PASS' WHEN share >= 50 THEN 'WARN' ELSE 'FAIL' END AS verdict, trim(split_part(output, '@@', 2)) AS range, 'static int fn(void)' AS function FROM (SELECT *, coalesce(len(list_filter(first, lambda x: x <> '' AND contains(input, x))) * 100.0::DOUBLE / nullif(len(first), 0), 0) AS share FROM (SELECT *, list_slice({_CHANGED.replace('diff_hunk', 'output')}, 1, 10) AS first FROM ({_STANDARD_ROWS})))",
)
_late("alpaca_prompts", lambda c, f: export.alpaca(export.records(export.standard(c, f))).select("prompt", "completion", "_commit_hash"),
       f"SELECT '### Instruction:' || chr(10) || instruction || CASE WHEN length(coalesce(input, '')) > 0 THEN chr(10) || chr(10) || '### Input:' || chr(10) || input ELSE '' END || chr(10) || chr(10) || '### Response:' || chr(10) AS prompt, output AS completion, commit_hash AS _commit_hash FROM ({_STANDARD.format(message=_strip(_MESSAGE), output='diff_hunk', where='true')})")
QUERIES["chatml_conversations"] = lambda spark, sf_dir: export.chatml_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
ORACLE_SQL["chatml_conversations"] = "SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>', chr(10) ORDER BY turn, role, text) AS chat FROM conversations GROUP BY conv_id"

# Raw rows, scoring by a model and comparison of models.
raw_queries.scoring_sql(_WITH)
QUERIES |= raw_queries.QUERIES | tree_queries.QUERIES
ORACLE_SQL |= raw_queries.ORACLE_SQL | tree_queries.ORACLE_SQL

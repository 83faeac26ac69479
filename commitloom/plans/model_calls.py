"""Work for a language model: prompts are expressions, the call is a function the caller gives, run by partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import text
from ..operators import clean, late, score, validate
from ..sources import scratch
from . import export, reply_ledger


def scoring_prompt(instruction: Column, diff: Column, context: Column | None = None) -> Column:
    a, b, c, d = config.SCORING_PARTS
    around = F.lit("") if context is None else F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit(b), text.prefix(context, config.INPUT_CUT), F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(F.lit(a), text.prefix(instruction, config.MAX_PROMPT_INSTRUCTION), F.lit("\n"), around, F.lit(c), text.prefix(diff, config.MAX_OUTPUT), F.lit(d))


def rewriting_prompt(message: Column, context: Column, diff: Column) -> Column:
    a, b, c, d = config.REWRITE_PARTS
    return F.concat(F.lit(a), message, F.lit(b), text.prefix(context, 2000), F.lit(c), text.prefix(diff, 4000), F.lit(d))


def call(rows: DataFrame, ask: Callable[[str], str], prompt: str = "prompt", reply: str = "reply", error: str = "error") -> DataFrame:
    """rows with the reply to each prompt; a call that raises leaves its message in `error` and the rest goes on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies, errors = [], []
            for p in batch[prompt]:
                try:
                    replies.append(ask(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  kept as data
                    replies.append(None)
                    errors.append(str(e))
            yield batch.assign(**{reply: pd.Series(replies, index=batch.index, dtype=object), error: pd.Series(errors, index=batch.index, dtype=object)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{schema}, `{reply}` string, `{error}` string")


def scoring_candidates(commits: export.Rows, files: export.Rows, min_heuristic: float = 30, limit: int | None = None) -> DataFrame:
    """Unscored commits, best first, with their first .c or .h diff of 50 to 8000 bytes if there is one."""
    c = late.table(commits).where((F.col("heuristic_score") >= min_heuristic) & F.col("ai_quality_score").isNull())
    wanted = c.carried("subject", "body", "heuristic_score", early=("commit_hash",))
    if limit:
        wanted = scratch.written(export.best(wanted, [-F.col("heuristic_score")], limit), "wanted")
    f = export.window_of(files, config.MIN_OUTPUT, config.MAX_OUTPUT).where(F.col("file_extension").isin(*config.CODE_EXTENSIONS))
    rows = scratch.written(export.first_files(wanted, f, "code_before", "diff_hunk", how="left", few=limit is not None), "unscored")  # read for those with a diff and those without
    return f.whole(c.whole(export.with_places(rows, f, optional=True)), optional=True)


def score_commits(commits: export.Rows, files: export.Rows, ask: Callable[[str], str], min_heuristic: float = 30, limit: int | None = None, ledger: str | None = None) -> DataFrame:
    """commits with model scores merged in: -1 without a valid diff, 0 if the call fails.

    With a ledger (a folder) no prompt is asked twice, however often this runs or fails; see `reply_ledger`. Store the scores by `versioned.update`.
    """
    rows = scoring_candidates(commits, files, min_heuristic, limit)
    commits = late.table(commits).rows
    context = clean.source_for(F.col("code_before"), F.col("diff_hunk"), places=F.col("places"))
    prompted = rows.where(F.col("diff_hunk").isNotNull()).select("commit_hash", scoring_prompt(export.message(), F.col("diff_hunk"), context).alias("prompt"))
    value, reason = score.parse_reply(F.col("reply"))
    asked = call(prompted, ask) if ledger is None else reply_ledger.ask_all(prompted, ask, ledger)
    answered = asked.select("commit_hash", value.alias("new_score"), reason.alias("new_reason"))
    answered = answered.select("commit_hash", F.coalesce("new_score", F.lit(0.0)).alias("new_score"), F.when(F.col("new_score").isNull(), "scoring failed").otherwise(F.substring("new_reason", 1, 500)).alias("new_reason"))
    skipped = rows.where(F.col("diff_hunk").isNull()).select("commit_hash", F.lit(-1.0).alias("new_score"), F.lit("no valid diff").alias("new_reason"))
    merged = commits.join(answered.unionByName(skipped), "commit_hash", "left")
    return merged.withColumn("ai_quality_score", F.coalesce("new_score", "ai_quality_score")).withColumn("ai_score_reason", F.coalesce("new_reason", "ai_score_reason")).select(*commits.columns)


def rewrite_gems(gems: DataFrame, ask: Callable[[str], str], count: int = 50) -> DataFrame:
    """Synthetic records: rewritten messages of hidden gems that pass lenient validation, `count` at most."""
    context = clean.source_for(F.col("code_before"), F.col("diff_hunk"))
    rows = gems.withColumn("original_instruction", text.strip(F.concat("subject", F.lit("\n"), "body"))).withColumn("input", context)
    rows = rows.withColumn("prompt", rewriting_prompt(F.col("original_instruction"), F.col("input"), F.col("diff_hunk")))
    made = call(rows.select("commit_hash", "original_instruction", "input", "diff_hunk", "prompt"), ask)
    made = made.withColumn("instruction", clean.instruction(F.coalesce("reply", F.lit("")))).withColumn("output", clean.output(F.col("diff_hunk")))
    valid = validate.with_reason(made, strict=False).where("reason IS NULL").orderBy("commit_hash").limit(count)
    return valid.select("instruction", "input", "output", "original_instruction", F.lit(True).alias("is_synthetic"), F.lit(5.0).alias("quality_score"), F.lit("Synthetic: rewritten message").alias("quality_reason"))

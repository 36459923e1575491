"""Checks before the first write of an ingest and after its last."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import gate, judge
from ..operators.sequence import keep_first


# Fixed value: how a selector starts that is a guess yet.
GUESS = "TODO-"


def uncalibrated(selectors: Mapping[str, str], pending: Collection[str] = ()) -> list[str]:
    """Names of selectors that are guesses, and of pending ones without a value, in order."""
    return sorted({n for n, s in selectors.items() if s.startswith(GUESS)} | {n for n in pending if not selectors.get(n)})


def require_calibrated(selectors: Mapping[str, str], names: Collection[str], pending: Collection[str] = ()) -> None:
    """An error if any of names isn't calibrated: a guess matches nothing and would lose rows silently."""
    if found := [n for n in uncalibrated(selectors, pending) if n in names]:
        raise ValueError(f"not calibrated: {found}")


def _findings(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _finding(rows: DataFrame, check: str, what: Column) -> DataFrame:
    return rows.select(F.lit(check).alias("check"), what.cast("string").alias("what"))


def preflight(records: DataFrame, judgments: DataFrame, contents: DataFrame, prompts: DataFrame) -> DataFrame:
    """(check, what) of all that forbids the ingest of records(url); none: it may begin.

    no_prompt (none is active), no_records, unjudged (a record without judgment), not_empty (the
    table has rows already), other_prompt (a judgment by another version than the active one).
    """
    active = prompts.where("is_active").agg(F.max("version").alias("active"))  # one row
    none = records.agg(F.count("*").alias("n"))
    old = judgments.select("prompt_version").distinct().crossJoin(F.broadcast(active)).where(~F.col("prompt_version").eqNullSafe(F.col("active").cast("string")))
    return _findings([
        _finding(active.where("active is null"), "no_prompt", F.lit("no active prompt")), _finding(none.where("n = 0"), "no_records", F.col("n")),
        _finding(records.select("url").join(judgments.select("url"), "url", "left_anti"), "unjudged", F.col("url")),
        _finding(contents.agg(F.count("*").alias("n")).where("n > 0"), "not_empty", F.col("n")), _finding(old, "other_prompt", F.col("prompt_version")),
    ])


def read_back(contents: DataFrame, analysis: DataFrame, authors: DataFrame, bridge: DataFrame, wanted: DataFrame, questions: DataFrame) -> DataFrame:
    """(check, what) of what isn't there as it was written; none: all is.

    no_analysis and no_content (contents and analyses that lack each other), no_author (a
    content's author that isn't known), missing_pair and extra_pair (event judgments against
    wanted(content_id, event_id)), null_relevance (questions that weren't decided).
    """
    pair = F.concat_ws(":", "content_id", "event_id")
    keys = ["content_id", "event_id"]
    return _findings([
        _finding(contents.join(analysis, "content_id", "left_anti"), "no_analysis", F.col("content_id")), _finding(analysis.join(contents, "content_id", "left_anti"), "no_content", F.col("content_id")),
        _finding(contents.where("author_id is not null").join(authors, "author_id", "left_anti"), "no_author", F.col("content_id")),
        _finding(wanted.join(bridge, keys, "left_anti"), "missing_pair", pair), _finding(bridge.join(wanted, keys, "left_anti"), "extra_pair", pair),
        _finding(questions.where("is_relevant is null"), "null_relevance", F.col("question_id")),
    ])


def tally(tables: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """(tbl, n, expected, ok) for each table that is expected."""
    parts = [tables[t].agg(F.count("*").alias("n")).select(F.lit(t).alias("tbl"), "n", F.lit(e).cast("long").alias("expected"), (F.col("n") == e).alias("ok")) for t, e in expected.items()]
    return _findings(parts)


def insert_contents(batch: DataFrame, contents: DataFrame) -> DataFrame:
    """A batch without judgments, for recovery: rows whose url is new, with parents as in the gated way. batch(ord, url, ...) comes back with inserted and parent_content_id."""
    return gate.resolve_parents(gate.new_rows(batch, contents, "url", "ord"))


def replay(bodies: DataFrame, questions: DataFrame, rules: list[tuple[str, bool, str, str]], fallback: tuple[bool, str, str]) -> DataFrame:
    """A run judged again by the rule judge, without the gate: bodies(file, ord, url, content_type, platform_id, platform_qid, title, text) with fate and judgment.

    questions(ord, platform_qid, title) are claimed once and judged by each row's title, one after
    another, so the last one's judgment stays. fate: unbuildable (a question among the bodies,
    or no id or address), inserted (the first buildable row of a url), duplicate. What could be
    built is judged by title and text, duplicates too.
    """
    judged_q = questions.groupBy("platform_qid").agg(F.max_by(judge.rule_judge(F.col("title"), rules, fallback)["is_relevant"], "ord").alias("question_relevant"))
    known = gate.buildable(bodies)
    first = keep_first(known.where("reject_reason is null"), ["url"], ["ord"]).select("ord", F.lit(True).alias("__first"))
    fate = F.when(F.col("reject_reason").isNotNull(), "unbuildable").when(F.col("__first"), "inserted").otherwise("duplicate")
    verdict = F.when(F.col("reject_reason").isNull(), judge.rule_judge(F.concat_ws("\n", "title", "text"), rules, fallback))
    rows = known.join(first, "ord", "left").withColumn("fate", fate).withColumn("v", verdict).select(*bodies.columns, "fate", "v.*")
    return rows.join(judged_q, "platform_qid", "left")


def replay_stats(replayed: DataFrame) -> DataFrame:
    """(file, rows, unbuildable, inserted, judged, duplicates)."""
    return replayed.groupBy("file").agg(F.count("*").alias("rows"), F.count_if(F.col("fate") == "unbuildable").alias("unbuildable"), F.count_if(F.col("fate") == "inserted").alias("inserted"), F.count_if(F.col("fate") != "unbuildable").alias("judged"), F.count_if(F.col("fate") == "duplicate").alias("duplicates"))

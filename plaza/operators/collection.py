"""Rules of collection rounds: specs, slices, stop conditions, targets, envelopes and truncation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The search page's options that apply where a spec names none.
SORT = {"backfill": "综合排序", "update": "最新发布"}
TIME = {"backfill": "不限时间", "update": "一天内"}
TYPE = "不限类型"
OPTIONS = {
    "sort": ("综合排序", "最多赞同", "最新发布"),
    "time": ("不限时间", "一天内", "一周内", "一月内", "三月内", "半年内", "一年内"),
    "type": ("不限类型", "只看回答", "只看文章", "只看视频"),
}


def spec_defaults(specs: DataFrame) -> DataFrame:
    """specs (mode, sort, time, type) with null options filled by mode; any mode but backfill counts as update."""

    def by_mode(values: dict[str, str]) -> Column:
        return F.when(F.col("mode") == "backfill", values["backfill"]).otherwise(values["update"])

    return specs.withColumns({"sort": F.coalesce("sort", by_mode(SORT)), "time": F.coalesce("time", by_mode(TIME)), "type": F.coalesce("type", F.lit(TYPE))})


def wrong_options(specs: DataFrame) -> DataFrame:
    """specs that name an option that the page doesn't have, with ``wrong``: the names of these columns. Null options are none named."""
    wrong = F.concat_ws(",", *(F.when(~F.col(c).isin(*options), c) for c, options in OPTIONS.items()))
    return specs.withColumn("wrong", wrong).where("wrong <> ''")


def checked_specs(specs: DataFrame) -> DataFrame:
    """specs as they are; any wrong option is an error, before a round begins."""
    if found := wrong_options(specs).select("wrong", *OPTIONS).limit(5).collect():
        raise ValueError(f"no such options: {[r.asDict() for r in found]}")
    return specs


def narrowed(specs: DataFrame, types: tuple[str, ...] = (), times: tuple[str, ...] = ()) -> DataFrame:
    """The specs of the given types and times (none given: all). No spec left is an error."""
    out = specs
    for column, values in (("type", types), ("time", times)):
        if values:
            out = out.where(F.col(column).isin(*values))
    if out.isEmpty():
        raise ValueError(f"no spec of types {types} and times {times}")
    return out


def tail_yield(marginal: DataFrame, last: int = 2, share: float = 0.2, least: int = 4) -> DataFrame:
    """One row (n_slices, tail_new, united, verdict) from the slices' new rows.

    verdict: ``full`` if the last slices brought nothing new, ``short`` if over ``share`` of the
    union, else ``enough``; null for fewer than ``least`` slices. marginal has one row a slice.
    """
    rank = F.row_number().over(Window.orderBy(F.desc("slice")))
    total = marginal.withColumn("r", rank).agg(F.count("*").alias("n_slices"), F.coalesce(F.sum(F.when(F.col("r") <= last, F.col("n_new"))), F.lit(0)).alias("tail_new"), F.coalesce(F.sum("n_new"), F.lit(0)).alias("united"))
    verdict = F.when(F.col("n_slices") >= least, F.when(F.col("tail_new") == 0, "full").when(F.col("tail_new") > F.col("united") * share, "short").otherwise("enough"))
    return total.withColumn("verdict", verdict)


def slice_metrics(rounds: DataFrame, keys: list[str], order: list[str], new: str, stop: str, end: str) -> DataFrame:
    """Per slice: rounds, rows collected, rounds without yield, and whether its last round ended with ``end``."""
    last = F.max_by(stop, F.struct(*order))
    return rounds.groupBy(*keys).agg(F.count("*").alias("n_rounds"), F.sum(new).alias("collected"), F.count_if(F.col(new) == 0).alias("stalled"), F.coalesce(last == end, F.lit(False)).alias("complete"))


def declared_reached(declared: Column, collected: Column) -> Column:
    """Whether to stop; an unknown declared number never stops."""
    return F.coalesce(collected >= declared, F.lit(False))


def exactly_one(rows: DataFrame, keys: list[str], recognised: Column) -> DataFrame:
    """The recognised candidate of each key that has exactly one; none is guessed for the others."""
    return rows.where(F.coalesce(recognised, F.lit(False))).withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where("__n = 1").drop("__n")


def targets(explicit: DataFrame, listed: DataFrame, key: str = "url") -> DataFrame:
    """Explicit rows and listed ones, each key once, explicit rows first (``rank`` 0 and 1)."""
    both = explicit.withColumn("rank", F.lit(0)).unionByName(listed.withColumn("rank", F.lit(1)), allowMissingColumns=True)
    others = [c for c in both.columns if c not in (key, "rank")]
    first = both.groupBy(key).agg(F.min(F.struct("rank", *others)).alias("f"))
    return first.select(key, "f.*")


def relevant_set(judgments: DataFrame, key: str) -> DataFrame:
    """Ids judged relevant; null is not."""
    return judgments.where("is_relevant = true").select(key).distinct()


def missing_pairs(contents: DataFrame, events: DataFrame, judged: DataFrame) -> DataFrame:
    """(content_id, event_id) still to be judged: of each content, the events without those that it has.

    The events of a round are a short list that a person keeps; they go to the contents as one array.
    """
    all_ = events.agg(F.sort_array(F.collect_set("event_id")).alias("__all"))  # one row
    own = judged.groupBy("content_id").agg(F.collect_set("event_id").alias("__own"))
    left = F.array_except("__all", F.coalesce("__own", F.array().cast(T.ArrayType(events.schema["event_id"].dataType))))
    return contents.select("content_id").distinct().join(own, "content_id", "left").crossJoin(F.broadcast(all_)).select("content_id", F.explode(left).alias("event_id"))


def push_prompt(prompts: DataFrame, new: DataFrame) -> DataFrame:
    """prompts (version, ..., is_active) with the new version added as the only active one. A known version is an error."""
    if not prompts.join(new, "version", "left_semi").isEmpty():
        raise ValueError("the version exists")
    return prompts.withColumn("is_active", F.lit(False)).unionByName(new.withColumn("is_active", F.lit(True)))


def active_prompt(prompts: DataFrame) -> DataFrame:
    return prompts.where("is_active").limit(1)


def reply_envelope(raw: Column) -> tuple[Column, Column]:
    """The message of a completion reply, and why there is none: ``not_json`` or ``wrong_shape``."""
    parsed = F.try_parse_json(raw)
    found = F.try_variant_get(parsed, "$.choices[0].message.content", "variant")
    text = F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))
    return text, F.when(parsed.isNull(), "not_json").when(text.isNull(), "wrong_shape")


def cross_check(content_type: Column, verified: tuple[str, ...], has_entity: Column, flagged: Column, dom_length: Column, json_length: Column) -> tuple[Column, Column]:
    """(checked, agree): whether a page's text is as long as its embedded data says.

    Only verified types whose entity was found are checked. A set truncation flag means no;
    agree is null where nothing can be compared. Lengths may differ by 200 characters and 5 %.
    """
    checked = F.coalesce(content_type.isin(*verified) & has_entity, F.lit(False))
    return checked, F.when(checked & F.coalesce(flagged, F.lit(False)), False).when(checked, dom_length + 200 >= json_length * 0.95)

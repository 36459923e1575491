"""Judgments, bodies and records: their shapes, and how one is made of another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_body
from ..functions.urls import profile_user_id, stripped
from ..sources.jsonl import append_log

ANALYSIS = ("content_id", "ai_summary", "platform_stance", "stance_confidence", "risk_level", "risk_reasoning", "model_version", "prompt_version")


def judgment_to_analysis(judgments: DataFrame, ids: DataFrame) -> DataFrame:
    """Analysis rows of judgments(url, ...) for ids(url, content_id); relevance isn't kept, versions are, analyzed_by is ai."""
    return judgments.join(ids, "url").select(*(F.col(c) for c in ANALYSIS)).withColumn("analyzed_by", F.lit("ai"))


def pick_body(inline: Column, full: Column, storage_path: Column) -> tuple[Column, Column]:
    """(body, fell_back): the inline text, else the full one; fell_back if a stored body should have been read instead."""
    own = has_body(inline)
    return F.when(own, stripped(inline)).otherwise(stripped(F.coalesce(full, F.lit("")))), ~own & F.coalesce(storage_path != "", F.lit(False))


def judgment_with_body(judgments: DataFrame, bodies: DataFrame) -> DataFrame:
    """judgments with the text of the body of their url; null if there is none. Of several bodies the first by (file_rank, line_no) counts."""
    text = bodies.groupBy("url").agg(F.min_by("text", F.struct("file_rank", "line_no")).alias("text"))
    return judgments.join(text, "url", "left")


def remap_events(judgments: DataFrame, ids: DataFrame) -> DataFrame:
    """judgments with the event ids of ids(file_id, event_id), a few rows, in place of a file's; one that isn't there keeps its own."""
    return judgments.join(ids.select(F.col("file_id").alias("__file"), F.col("event_id").alias("__to")), F.col("event_id") == F.col("__file"), "left").withColumn("event_id", F.coalesce("__to", "event_id")).drop("__file", "__to")


def event_briefs(events: DataFrame) -> DataFrame:
    """(event_id string, version, name, summary, keywords, start_date, end_date) with defaults: version 1, an empty name, no keywords."""
    return events.select(
        F.col("event_id").cast("string").alias("event_id"), F.coalesce("version", F.lit(1)).cast("int").alias("version"), F.coalesce("name", F.lit("")).alias("name"), "summary",
        F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"), F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"),
    )


def needle_filter(rows: DataFrame, fields: tuple[str, ...], needles: tuple[str, ...]) -> DataFrame:
    """Rows of which some field holds some needle; no needles pass all."""
    hay = F.concat_ws("\n", *(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields))
    hit = F.lit(not needles)
    for n in needles:
        hit = hit | F.contains(hay, F.lit(n))
    return rows.where(hit)


def review_pages(judgments: DataFrame, bodies: DataFrame, event_judgments: DataFrame) -> DataFrame:
    """(url, is_relevant, platform_stance, risk_level, text, events): a page for each judgment, with its body and its judged events by name, relevant ones first."""
    one = F.struct((~F.coalesce("is_relevant", F.lit(False))).alias("unrelated"), F.col("event_name").alias("name"), "stance")
    events = event_judgments.groupBy("url").agg(F.array_sort(F.collect_list(one)).alias("events"))
    return judgment_with_body(judgments, bodies).join(events, "url", "left").select("url", "is_relevant", "platform_stance", "risk_level", "text", F.coalesce(F.transform("events", lambda e: F.concat_ws(" ", F.when(e["unrelated"], "-").otherwise("+"), e["name"], F.coalesce(e["stance"], F.lit("?")))), F.array().cast("array<string>")).alias("events"))


def document_to_record(rows: DataFrame) -> DataFrame:
    """Content records of document rows: lengths and parents under their names in the tables, the author's id from the profile address, missing counts 0."""
    return rows.select(
        "content_type", "platform_id", "url", profile_user_id(F.col("author_url")).alias("author_platform_id"), "author_name", "author_url", F.col("question_id").alias("question_platform_id"),
        F.col("parent_id").alias("parent_platform_id"), "title", "content_text", "storage_path", F.coalesce("voteup_count", F.lit(0)).alias("voteup_count"), F.coalesce("comment_count", F.lit(0)).alias("comment_count"),
        F.col("text_length").alias("content_length"), "raw_content_hash", "snapshot_path", F.to_timestamp("published_at").alias("published_at"),
    )


def to_document(items: DataFrame, inline: int, keyword: Column, collected_at: Column) -> DataFrame:
    """Document rows of parsed items(url, content_type, platform_id, text, html, ...): a text of more than ``inline`` characters goes to a file whose key is kept, other columns pass."""
    from ..functions.text import content_hash
    from ..functions.urls import storage_key

    long = F.coalesce(F.length("text") > inline, F.lit(False))
    key = lambda file: storage_key(F.col("content_type"), F.col("platform_id"), file)
    return items.select(
        *(c for c in items.columns if c != "html"), F.length("text").alias("text_length"), F.when(~long, F.col("text")).alias("content_text"), F.when(long, key("text.txt.gz")).alias("storage_path"),
        content_hash(F.col("text"), F.col("html")).alias("raw_content_hash"), F.when(F.col("html").isNotNull(), key("snapshot.html.gz")).alias("snapshot_path"), keyword.alias("keyword"), collected_at.alias("collected_at"),
    )


def append_judgments(rows: DataFrame, written: DataFrame, run: str, name: str, force: bool = False) -> None:
    """Appends judgments to a run's log; refuses to mix prompt versions with those written unless forced."""
    versions = {r[0] for r in rows.select("prompt_version").unionByName(written.select("prompt_version")).distinct().limit(3).collect()}
    if len(versions) > 1 and not force:
        raise ValueError(f"prompt versions would be mixed: {sorted(map(str, versions))}")
    append_log(rows, run, name)

"""Admission: parents within a batch, dispositions of contents and event judgments, and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CONTENT_TYPES, EVENT_STANCES, UNRELATED


def resolve_parents(batch: DataFrame) -> DataFrame:
    """batch(ord, content_type, platform_id, parent_platform_id, inserted, content_id) with parent_content_id.

    A parent is a row of this batch that was inserted before its child and carries the id. The
    latest of the child's own type is taken; if that type has none, the latest of the type
    that had the id first.
    """
    child = batch.where("parent_platform_id is not null").select("ord", F.col("content_type").alias("own"), F.col("parent_platform_id").alias("pid"))
    parent = batch.where("inserted").select(F.col("ord").alias("p_ord"), F.col("content_type").alias("p_type"), F.col("platform_id").alias("p_id"), F.col("content_id").alias("parent"))
    pairs = child.join(parent, (F.col("pid") == F.col("p_id")) & (F.col("p_ord") < F.col("ord")))
    by_type = pairs.groupBy("ord", "own", "p_type").agg(F.min("p_ord").alias("first"), F.max_by("parent", "p_ord").alias("parent"))
    best = by_type.groupBy("ord").agg(F.min_by("parent", F.struct(F.col("p_type") != F.col("own"), "first")).alias("parent_content_id"))
    return batch.join(best, "ord", "left")


def content_disposition(records: DataFrame, judgments: DataFrame, relevant_questions: DataFrame, known_questions: DataFrame, order: str | None = None) -> DataFrame:
    """records(url, content_type, question_id) with disposition and stance_conflict.

    In this order: rejected_question, unjudged, kept, dropped_irrelevant (no question above),
    kept_by_parent (its question is relevant this round), dropped_unknown_parent (its question
    isn't known), dropped_irrelevant. An undecided relevance counts as not relevant. Of several
    judgments of a url the last by ``order`` counts. stance_conflict: kept by its question, but
    its stance is anything but unrelated, null included.
    """
    last = judgments.select("url", "is_relevant", "platform_stance", (F.col(order) if order else F.lit(0)).alias("at"))
    last = last.groupBy("url").agg(F.max_by(F.struct("is_relevant", "platform_stance"), "at").alias("j")).select("url", "j.*")
    verdict = last.select("url", F.coalesce("is_relevant", F.lit(False)).alias("relevant"), "platform_stance", F.lit(True).alias("judged"))
    now = relevant_questions.select("question_id").distinct().withColumn("q_relevant", F.lit(True))
    known = known_questions.select("question_id").distinct().withColumn("q_known", F.lit(True))
    rows = records.join(verdict, "url", "left").join(now, "question_id", "left").join(known, "question_id", "left")
    disposition = (
        F.when(F.col("content_type") == "question", "rejected_question").when(F.col("judged").isNull(), "unjudged").when(F.col("relevant"), "kept")
        .when(F.col("question_id").isNull(), "dropped_irrelevant").when(F.col("q_relevant"), "kept_by_parent").when(F.col("q_known").isNull(), "dropped_unknown_parent").otherwise("dropped_irrelevant")
    )
    rows = rows.withColumn("disposition", disposition)
    conflict = (F.col("disposition") == "kept_by_parent") & ~F.col("platform_stance").eqNullSafe(UNRELATED)
    return rows.withColumn("stance_conflict", conflict).drop("judged", "q_relevant", "q_known")


def event_disposition(judgments: DataFrame, inserted: DataFrame, events: DataFrame) -> DataFrame:
    """judgments(content_id, event_id string, is_relevant, stance, event_version) with disposition.

    In this order: skipped_irrelevant, orphaned (content not inserted in this batch), unknown_event
    (no whole number, or no such event), version_mismatch, bad_stance, saved.
    """
    own = inserted.select("content_id").distinct().withColumn("here", F.lit(True))
    current = events.select(F.col("event_id").alias("eid"), F.col("version").alias("current"))
    rows = judgments.withColumn("eid", F.col("event_id").try_cast("long")).join(own, "content_id", "left").join(current, "eid", "left")
    disposition = (
        F.when(~F.coalesce("is_relevant", F.lit(False)), "skipped_irrelevant").when(F.col("here").isNull(), "orphaned").when(F.col("current").isNull(), "unknown_event")
        .when(~F.col("event_version").eqNullSafe(F.col("current")), "version_mismatch").when(~F.coalesce(F.col("stance").isin(*EVENT_STANCES), F.lit(False)), "bad_stance").otherwise("saved")
    )
    return rows.withColumn("disposition", disposition).drop("here", "current", "eid")


def report(classified: DataFrame) -> DataFrame:
    """Rows by disposition; they add up to the input."""
    return classified.groupBy("disposition").agg(F.count("*").alias("n"))


def buildable(documents: DataFrame) -> DataFrame:
    """documents with reject_reason: null if the row can become a record."""
    reason = F.when(F.coalesce("platform_id", F.lit("")) == "", "no_id").when(F.coalesce("url", F.lit("")) == "", "no_url").when(~F.coalesce(F.col("content_type").isin(*CONTENT_TYPES), F.lit(False)), "bad_type")
    return documents.withColumn("reject_reason", reason)


def ingest_report(batch: DataFrame) -> DataFrame:
    """One row of counters over a resolved batch; duplicates count into all but inserted."""
    return batch.agg(
        F.count_if("inserted").alias("inserted"), F.count_if(~F.col("inserted")).alias("duplicates"),
        F.count_if(F.col("parent_platform_id").isNotNull() & F.col("parent_content_id").isNull()).alias("dangling_parents"), F.count_if(F.col("snapshot_path").isNull()).alias("no_snapshot"),
        F.count_if(F.col("author_id").isNull()).alias("unresolved_authors"), F.count_if(F.col("question_id").isNull()).alias("unresolved_questions"),
    )


def new_rows(batch: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """batch with inserted: the first row of a key that isn't there yet."""
    there = existing.select(F.col(key).alias("__key")).distinct().withColumn("__there", F.lit(True))
    first = F.row_number().over(Window.partitionBy(key).orderBy(order)) == 1
    return batch.withColumn("__first", first).join(there, F.col(key) == F.col("__key"), "left").withColumn("inserted", F.col("__first") & F.col("__there").isNull()).drop("__first", "__key", "__there")

"""Changes to single tables, each as the next version of the table.

All take the current table and a batch of changes with an ``ord``, and act as if the changes
were applied one after another. A change that hits no row is silent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def set_relevance(questions: DataFrame, changes: DataFrame) -> DataFrame:
    """changes(ord, question_id, is_relevant, relevant_checked_at): both fields as last given; no other field is touched."""
    return store.patch(questions, changes, ["question_id"], "ord", ["is_relevant", "relevant_checked_at"], insert_missing=False)


def mark_answers_collected(questions: DataFrame, changes: DataFrame) -> DataFrame:
    """changes(ord, question_id, answers_collected_at)."""
    return store.patch(questions, changes, ["question_id"], "ord", ["answers_collected_at"], insert_missing=False)


def refresh_metrics(contents: DataFrame, changes: DataFrame) -> DataFrame:
    """changes(ord, content_id, voteup_count, comment_count): the two counters only, never text or hash."""
    return store.patch(contents, changes, ["content_id"], "ord", ["voteup_count", "comment_count"], insert_missing=False)


def mark_status(contents: DataFrame, changes: DataFrame) -> DataFrame:
    """changes(ord, content_id, status)."""
    return store.patch(contents, changes, ["content_id"], "ord", ["status"], insert_missing=False)


def set_author_watch(authors: DataFrame, changes: DataFrame) -> DataFrame:
    """changes(ord, author_id, stance, is_watched, watch_note): null leaves a field as it is."""
    return store.patch(authors, changes, ["author_id"], "ord", ["stance", "is_watched", "watch_note"], insert_missing=False)


def update_event(events: DataFrame, changes: DataFrame, fields: tuple[str, ...] = ("name", "summary", "keywords", "start_date", "end_date")) -> tuple[DataFrame, DataFrame]:
    """(next version, event_id of the events hit): given fields replace, each change with ``bump`` raises the version by one, ``backfill_scanned`` stays once set.

    changes(ord, event_id, bump, backfill_scanned, and any of the fields).
    """
    own = [f for f in fields if f in changes.columns and f in events.columns]
    sums = changes.groupBy("event_id").agg(F.count_if(F.coalesce("bump", F.lit(False))).alias("__bumps"), F.coalesce(F.bool_or("backfill_scanned"), F.lit(False)).alias("__scanned"))
    after = store.patch(events, changes, ["event_id"], "ord", own, insert_missing=False) if own else events
    both = after.join(sums, "event_id", "left")
    new = {"version": F.col("version") + F.coalesce("__bumps", F.lit(0)).cast(events.schema["version"].dataType), "backfill_scanned": F.col("backfill_scanned") | F.coalesce("__scanned", F.lit(False))}
    return both.select(*(new[c].alias(c) if c in new else F.col(c) for c in events.columns)), events.join(sums, "event_id", "left_semi").select("event_id")


def overwrite_event_stance(bridge: DataFrame, changes: DataFrame, events: DataFrame) -> DataFrame:
    """A person's stances: given fields replace or a row is made; analyzed_by becomes human and event_version the event's current one (null if there is none).

    changes(ord, content_id, event_id, stance, confidence, notes).
    """
    now = events.select("event_id", F.col("version").alias("event_version"))
    versioned = changes.join(now, "event_id", "left")
    keys = ["content_id", "event_id"]
    patched = store.patch(bridge, versioned, keys, "ord", ["stance", "confidence", "notes"], {"analyzed_by": F.lit("human")})
    hit = versioned.groupBy(*keys).agg(F.max("event_version").alias("__version"), F.lit(True).alias("__hit"))
    joined = patched.join(hit, keys, "left")
    return joined.select(*(F.when(F.col("__hit"), F.col("__version")).otherwise(F.col(c)).cast(bridge.schema[c].dataType).alias(c) if c == "event_version" else F.col(c) for c in bridge.columns))


def claim_questions(questions: DataFrame, claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(next version, (ord, platform_qid, question_id) of the claims that came first): a question is made once; the fields of one that exists are never changed.

    claims(ord, platform_qid, and columns of questions). A claim is before any judgment: what it
    says of relevance isn't taken, both fields are null until they are set. A claim that isn't in
    the second table came second. A new id continues the table's, in order of the claims.
    """
    kept = [c for c in claims.columns if c not in ("ord", "platform_qid", "is_relevant", "relevant_checked_at")]
    first = claims.groupBy("platform_qid").agg(F.min("ord").alias("ord"), F.min_by(F.struct(*kept), "ord").alias("c")).select("ord", "platform_qid", "c.*")
    fresh = store.with_ids(first.join(questions, "platform_qid", "left_anti"), questions, "question_id", "ord")
    rows = fresh.select(*((F.col(c) if c in fresh.columns else F.lit(None)).cast(questions.schema[c].dataType).alias(c) for c in questions.columns))
    return questions.unionByName(rows), fresh.select("ord", "platform_qid", "question_id")


def content_and_analysis(admitted: DataFrame, content: tuple[str, ...], analysis: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables from one admitted table, so that each content has exactly one analysis; a row without a judgment is an error of the gate and raises when it is read."""
    whole = admitted.withColumn("platform_stance", F.when(F.col("platform_stance").isNull() & F.col("risk_level").isNull(), F.raise_error(F.concat(F.lit("no judgment of "), F.col("content_id")))).otherwise(F.col("platform_stance")))
    return whole.select(*content), whole.select("content_id", *(c for c in analysis if c != "content_id"))

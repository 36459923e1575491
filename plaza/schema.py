"""Tables: their columns, allowed values and keys, and checks of these rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ddl import columns

# The domains of the star schema.
AUTHOR_STANCES = EVENT_STANCES = ("正向", "反向", "中立")
PLATFORM_STANCES = ("有利", "抹黑", "中立", "不相关")
UNRELATED = "不相关"
RISKS = ("低风险", "中风险", "高风险")
CONTENT_TYPES = ("answer", "article", "thought", "comment")
CONTENT_STATES = ("active", "deleted_detected", "edited_detected")
EVENT_TYPES = ("new", "backfill")
ANALYSTS = ("ai", "human")


@dataclass(frozen=True)
class Table:
    name: str
    columns: T.StructType
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: column -> (table, column)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


def _table(name: str, ddl: str, key: tuple[str, ...], **rules) -> Table:
    return Table(name, columns(ddl), key, **rules)


TABLES = {
    t.name: t
    for t in (
        _table("dim_author", "author_id long, platform_user_id string, nickname string, profile_url string, stance string, is_watched boolean, watch_note string, first_seen_at timestamp, last_seen_at timestamp", ("author_id",), unique=(("platform_user_id",),), allowed={"stance": AUTHOR_STANCES}),
        _table("dim_question", "question_id long, platform_qid string, url string, title string, description string, is_relevant boolean, relevant_checked_at timestamp, follow_up_done boolean, answers_collected_at timestamp, first_seen_at timestamp, asked_at timestamp, follower_count long, view_count long, answer_count long", ("question_id",), unique=(("platform_qid",),)),
        _table("dim_event", "event_id long, name string, summary string, keywords array<string>, event_type string, backfill_scanned boolean, version int, start_date date, end_date date, created_at timestamp", ("event_id",), allowed={"event_type": EVENT_TYPES}),
        _table("fact_content", "content_id string, content_type string, status string, platform_id string, url string, author_id long, question_id long, parent_id string, title string, content_text string, storage_path string, voteup_count int, comment_count int, content_length int, raw_content_hash string, snapshot_path string, published_at timestamp, collected_at timestamp", ("content_id",), unique=(("url",),), allowed={"content_type": CONTENT_TYPES, "status": CONTENT_STATES}, references={"author_id": ("dim_author", "author_id"), "question_id": ("dim_question", "question_id"), "parent_id": ("fact_content", "content_id")}),
        _table("fact_analysis", "content_id string, ai_summary string, platform_stance string, stance_confidence double, risk_level string, risk_reasoning string, analyzed_by string, model_version string, prompt_version string, analyzed_at timestamp, reviewed_by string", ("content_id",), allowed={"platform_stance": PLATFORM_STANCES, "risk_level": RISKS, "analyzed_by": ANALYSTS}, references={"content_id": ("fact_content", "content_id")}),
        _table("fact_content_event", "content_id string, event_id long, stance string, confidence double, analyzed_by string, event_version int, prompt_version string, notes string, analyzed_at timestamp", ("content_id", "event_id"), allowed={"stance": EVENT_STANCES, "analyzed_by": ANALYSTS}, references={"content_id": ("fact_content", "content_id"), "event_id": ("dim_event", "event_id")}),
        _table("fact_evidence", "evidence_id long, content_id string, evidence_type string, evidence_number string, filed_by string, filed_at timestamp, notes string", ("evidence_id",), references={"content_id": ("fact_content", "content_id")}),
        _table("dim_prompt", "prompt_id long, version int, content_hash string, content map<string,string>, is_active boolean, note string, created_at timestamp", ("prompt_id",), unique=(("version",),)),
    )
}


def enum_violations(df: DataFrame, allowed: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows with a value outside its domain (null is allowed), one for each such column as ``violated``."""
    bad = F.array(*(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), F.lit(c)) for c, v in allowed.items()))
    return df.withColumn("violated", F.explode(F.filter(bad, lambda c: c.isNotNull())))


def duplicate_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys without nulls that occur more than once."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, column: str, parents: DataFrame, parent: str) -> DataFrame:
    """Rows whose reference isn't null and points nowhere."""
    known = parents.select(F.col(parent).alias("__parent"))
    return df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__parent"), "left_anti")


def body_missing(df: DataFrame) -> DataFrame:
    return df.where("content_text is null and storage_path is null")


# --- the rules of all tables at once ---


def _united(parts: list[DataFrame], spark_of: DataFrame, ddl: str) -> DataFrame:
    out = spark_of.sparkSession.createDataFrame([], ddl)
    for p in parts:
        out = out.unionByName(p)
    return out


def all_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, violated, n): values outside their domain, in the columns that are there; an unknown table name raises."""
    parts = []
    for name, df in tables.items():
        allowed = {c: v for c, v in TABLES[name].allowed.items() if c in df.columns}
        if allowed:
            parts.append(enum_violations(df, allowed).groupBy("violated").agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "violated", "n"))
    return _united(parts, next(iter(tables.values())), "tbl string, violated string, n long")


def all_duplicates(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, key, value, n): keys and unique columns that repeat; the parts of a key are joined by commas."""
    parts = []
    for name, df in tables.items():
        for key in (TABLES[name].key, *TABLES[name].unique):
            if set(key) <= set(df.columns):
                parts.append(duplicate_keys(df, key).select(F.lit(name).alias("tbl"), F.lit(",".join(key)).alias("key"), F.concat_ws(",", *(F.col(k).cast("string") for k in key)).alias("value"), "n"))
    return _united(parts, next(iter(tables.values())), "tbl string, key string, value string, n long")


def all_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, reference, value, n): references that point nowhere, where both tables are there."""
    parts = []
    for name, df in tables.items():
        for column, (other, parent) in TABLES[name].references.items():
            if column in df.columns and other in tables and parent in tables[other].columns:
                lost = orphans(df.select(column), column, tables[other].select(parent), parent).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
                parts.append(lost.select(F.lit(name).alias("tbl"), F.lit(column).alias("reference"), "value", "n"))
    return _united(parts, next(iter(tables.values())), "tbl string, reference string, value string, n long")

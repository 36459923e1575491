"""The analytic queries over contents, analyses, events and evidence."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ContentFilter:
    """Predicates that are all to hold; None puts no condition."""

    author: str | None = None
    platform_stance: str | None = None
    risk: str | None = None
    content_type: str | None = None
    published_from: datetime | None = None
    published_to: datetime | None = None
    collected_from: datetime | None = None
    event_id: int | None = None
    event_stance: str | None = None


#: Columns that results can be sorted by.
SORTS = ("collected_at", "published_at", "voteup_count", "comment_count")
RESULT = ("content_id", "content_type", "platform_id", "url", "title", "author_id", "author_name", "author_platform_id", "published_at", "collected_at", "voteup_count", "comment_count", "ai_summary", "platform_stance", "stance_confidence", "risk_level", "risk_reasoning", "analyzed_by")


def _when_set(value: object, condition: Column) -> list[Column]:
    return [] if value is None else [condition]


def named(authors: DataFrame) -> DataFrame:
    """The authors as results show them; at most one row an author_id."""
    return authors.select("author_id", F.col("nickname").alias("author_name"), F.col("platform_user_id").alias("author_platform_id"))


def matching(content: DataFrame, analysis: DataFrame, authors: DataFrame, bridge: DataFrame, flt: ContentFilter) -> DataFrame:
    """Contents that pass, with their analysis and author. Either is joined inner if it is filtered on, else left; events are a semi-join, so nothing is doubled."""
    where = [
        *_when_set(flt.content_type, F.col("content_type") == flt.content_type),
        *_when_set(flt.published_from, F.col("published_at") >= F.lit(flt.published_from)), *_when_set(flt.published_to, F.col("published_at") <= F.lit(flt.published_to)),
        *_when_set(flt.collected_from, F.col("collected_at") >= F.lit(flt.collected_from)),
    ]
    rows = content.where(reduce(lambda a, b: a & b, where)) if where else content
    if flt.event_id is not None or flt.event_stance is not None:
        both = [*_when_set(flt.event_id, F.col("event_id") == flt.event_id), *_when_set(flt.event_stance, F.col("stance") == flt.event_stance)]
        rows = rows.join(bridge.where(reduce(lambda a, b: a & b, both)), "content_id", "left_semi")
    judged = [*_when_set(flt.platform_stance, F.col("platform_stance") == flt.platform_stance), *_when_set(flt.risk, F.col("risk_level") == flt.risk)]
    own = analysis.where(reduce(lambda a, b: a & b, judged)) if judged else analysis
    rows = rows.join(own, "content_id", "inner" if judged else "left")
    if flt.author is None:
        return rows.join(named(authors), "author_id", "left")
    return rows.join(named(authors).where(F.col("author_platform_id") == flt.author), "author_id")


def search(content: DataFrame, analysis: DataFrame, authors: DataFrame, bridge: DataFrame, flt: ContentFilter = ContentFilter(), sort: str = "collected_at", descending: bool = True, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of results; nulls come first when descending and last when ascending, ties by id."""
    if sort not in SORTS:
        raise ValueError(f"can't sort by {sort!r}; one of {SORTS}")
    order = F.col(sort).desc_nulls_first() if descending else F.col(sort).asc_nulls_last()
    return matching(content, analysis, authors, bridge, flt).select(*RESULT).orderBy(order, "content_id").offset(offset).limit(limit)


def count(content: DataFrame, analysis: DataFrame, authors: DataFrame, bridge: DataFrame, flt: ContentFilter = ContentFilter()) -> DataFrame:
    return matching(content, analysis, authors, bridge, flt).agg(F.count("*").alias("n"))


def alerts(content: DataFrame, analysis: DataFrame, authors: DataFrame, since: Column, risks: tuple[str, ...], limit: int = 20) -> DataFrame:
    """Newest contents of the given risks collected since a time."""
    rows = content.where(F.col("collected_at") >= since).join(analysis.where(F.col("risk_level").isin(*risks)), "content_id")
    return rows.join(named(authors), "author_id", "left").select(*RESULT).orderBy(F.desc("collected_at"), "content_id").limit(limit)


def count_by_risk(content: DataFrame, analysis: DataFrame, since: Column) -> DataFrame:
    return content.where(F.col("collected_at") >= since).join(analysis.where("risk_level is not null"), "content_id").groupBy("risk_level").agg(F.count("*").alias("n"))


def list_events(events: DataFrame, bridge: DataFrame, include_empty: bool = True) -> DataFrame:
    """Events with the number of contents that have a stance on them, newest first."""
    n = bridge.where("stance is not null").groupBy("event_id").agg(F.count("content_id").alias("n"))
    rows = events.join(n, "event_id", "left").withColumn("n_contents", F.coalesce("n", F.lit(0))).drop("n")
    return rows.where((F.col("n_contents") > 0) | F.lit(include_empty)).orderBy(F.desc("event_id"))


def stale(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """Bridge rows judged against another version of the event than its current one."""
    now = events.select("event_id", F.col("version").alias("current"))
    return bridge.join(now, "event_id").where(~F.col("event_version").eqNullSafe(F.col("current")))


def evidence_for(evidence: DataFrame, content_id: int, limit: int = 50) -> DataFrame:
    return evidence.where(F.col("content_id") == content_id).orderBy(F.desc("filed_at"), F.desc("evidence_id")).limit(limit)


FILTERS = tuple(f.name for f in fields(ContentFilter))

"""Rows by their keys: single questions to a table as one join, and rows in the shape of their table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TABLES

#: name -> (table, its key, what is answered; nothing: the whole row)
LOOKUPS: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    "question_by_id": ("dim_question", ("question_id",), ()),
    "question_id_for": ("dim_question", ("platform_qid",), ("question_id",)),
    "author_id_for": ("dim_author", ("platform_user_id",), ("author_id",)),
    "event_by_id": ("dim_event", ("event_id",), ()),
    "content_by_id": ("fact_content", ("content_id",), ()),
    "content_id_for": ("fact_content", ("url",), ("content_id",)),
    "analysis_for": ("fact_analysis", ("content_id",), ()),
    "event_stance_of": ("fact_content_event", ("content_id", "event_id"), ()),
    "prompt_by_version": ("dim_prompt", ("version",), ()),
}


def as_record(rows: DataFrame, table: str) -> DataFrame:
    """rows with the columns of a table in its order and types, decimals as doubles; a column that it doesn't know raises, one that is missing is null."""
    fields = {f.name: f for f in TABLES[table].columns.fields}
    if unknown := [c for c in rows.columns if c not in fields]:
        raise ValueError(f"{table} has no {unknown}")
    return rows.select(*((F.col(n) if n in rows.columns else F.lit(None)).cast(f.dataType).alias(n) for n, f in fields.items()))


def look_up(asked: DataFrame, name: str, table: DataFrame) -> DataFrame:
    """asked with ``found`` and ``answer``, a struct of what LOOKUPS[name] says; null where nothing is found.

    Keys are unique in their table; a null key finds nothing. Asked rows keep their number, equal
    ones too, and a question costs no request: all are one join.
    """
    _, keys, answer = LOOKUPS[name]
    known = table.select(*(F.col(k).alias(f"__{k}") for k in keys), F.struct(*(answer or table.columns)).alias("answer"))
    same = [F.col(k) == F.col(f"__{k}") for k in keys]
    out = asked.drop("found", "answer").join(known, same, "left")
    return out.withColumn("found", F.col("answer").isNotNull()).drop(*(f"__{k}" for k in keys))

"""Which migrations are pending, drifted or orphaned, and a backfill's search matrix."""

from __future__ import annotations

from difflib import unified_diff

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.runs import exists


def migration_plan(files: DataFrame, applied: DataFrame) -> DataFrame:
    """files(version, checksum) against applied(version, checksum): version and status; anything drifted or orphaned blocks."""
    a, b = files.select("version", F.col("checksum").alias("now")), applied.select("version", F.col("checksum").alias("then"))
    status = F.when(F.col("then").isNull(), "pending").when(F.col("now").isNull(), "orphaned").when(F.col("now") != F.col("then"), "drifted").otherwise("applied")
    rows = a.join(b, "version", "full").select("version", status.alias("status"))
    return rows.withColumn("blocked", F.col("status").isin("drifted", "orphaned"))


def tracking_state(spark: SparkSession, path: str) -> DataFrame:
    """(version, checksum, applied_sql) of the table of applied migrations, which is only read.

    No table: no rows. A table older than the column applied_sql: nulls there.
    """
    kept = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("checksum", T.StringType()), T.StructField("applied_sql", T.StringType())])
    if not exists(spark, path):
        return spark.createDataFrame([], kept)
    rows = spark.read.parquet(path)
    return rows.select(*(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kept))


@F.pandas_udf(T.StringType())
def _difference(then: pd.Series, now: pd.Series) -> pd.Series:
    return pd.Series(["\n".join(unified_diff(a.splitlines(), b.splitlines(), "applied", "file", lineterm="")) if isinstance(a, str) and isinstance(b, str) else None for a, b in zip(then, now)], dtype=object)


def drift(files: DataFrame, applied: DataFrame) -> DataFrame:
    """(version, diff) of the drifted migrations: a unified diff from the text applied to the file's, null where none was stored."""
    now = files.select("version", F.col("checksum").alias("now"), "sql")
    return applied.join(now, "version").where("checksum <> now").select("version", _difference("applied_sql", "sql").alias("diff"))


def accept_drift(files: DataFrame, applied: DataFrame, version: int, note: str) -> DataFrame:
    """applied with one drifted version's checksum and text taken from its file, and why in ``note``. No note, or a version that hasn't drifted, is an error."""
    if not note.strip():
        raise ValueError("a drift is accepted with a note")
    if migration_plan(files, applied).where((F.col("version") == version) & (F.col("status") == "drifted")).isEmpty():
        raise ValueError(f"version {version} hasn't drifted")
    fresh = files.where(F.col("version") == version).select("version", F.col("checksum").alias("__checksum"), F.col("sql").alias("__sql"))
    old = F.col("note") if "note" in applied.columns else F.lit(None).cast("string")
    hit = F.col("__checksum").isNotNull()
    return applied.join(F.broadcast(fresh), "version", "left").select("version", F.coalesce("__checksum", "checksum").alias("checksum"), F.when(hit, F.col("__sql")).otherwise(F.col("applied_sql")).alias("applied_sql"), F.when(hit, note.strip()).otherwise(old).alias("note"))


def with_texts(files: DataFrame, applied: DataFrame) -> DataFrame:
    """applied with texts that weren't stored filled from the files; only where the checksums are equal."""
    now = files.select("version", "checksum", F.col("sql").alias("__sql"))
    return applied.join(now, ["version", "checksum"], "left").withColumn("applied_sql", F.coalesce("applied_sql", "__sql")).drop("__sql")


# What a search can be narrowed to.
BACKFILL_TYPES = ("answer", "article")
WINDOWS = ("一天内", "一周内", "一月内", "三月内", "半年内", "一年内")


def backfill_matrix(keywords: DataFrame) -> DataFrame:
    """Each keyword with all types and windows: twelve searches."""
    kinds, times = F.explode(F.array(*map(F.lit, BACKFILL_TYPES))), F.explode(F.array(*map(F.lit, WINDOWS)))
    return keywords.withColumn("content_type", kinds).withColumn("time_window", times)

"""Operators whose result depends on arrival order, as window functions over an explicit position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with their number from 0 on in a total order of the whole table.

    Rows are dealt by ranges of the order, sorted and counted; each range's number of rows is
    added up over the ranges before it, so no task sees the whole table. The numbers inside the
    ranges are written once: counted from the plan again, ranges could be sampled or joined
    together in another way.
    """
    part, at = F.spark_partition_id().alias("__part"), F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*(F.col(c) for c in order)).sortWithinPartitions(*order)
    placed = written(ranged.select("*", part, (at % (1 << 33)).alias("__in")), "numbered")
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))  # a row a partition
    before = counts.select(F.col("__part").alias("__of"), (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return placed.join(F.broadcast(before), F.col("__part") == F.col("__of")).withColumn(name, F.col("__before") + F.col("__in")).drop("__part", "__in", "__of", "__before")


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def last_of(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The last n rows of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order)))).where(F.col("__n") <= n).drop("__n")


def known_run(rows: DataFrame, keys: list[str], order: list[str], known: Column, length: int = 5) -> DataFrame:
    """For each key: where the first run of ``length`` known rows in a row begins, and the row at which reading stops; nulls if it never does."""
    by = Window.partitionBy(*keys).orderBy(*order)
    at = rows.withColumn("__known", F.coalesce(known, F.lit(False))).withColumn("pos", F.row_number().over(by))
    island = at.withColumn("__island", F.sum((~F.col("__known")).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))).where("__known")
    runs = island.withColumn("__in", F.row_number().over(Window.partitionBy(*keys, "__island").orderBy("pos"))).where(F.col("__in") == length)
    stops = runs.groupBy(*keys).agg(F.min("pos").alias("stop_pos"))
    return rows.select(*keys).distinct().join(stops, keys, "left").select(*keys, (F.col("stop_pos") - length + 1).alias("run_pos"), "stop_pos")


def marginal_new(rows: DataFrame, slice_: str, key: str) -> DataFrame:
    """(slice, n_new, cumulative): keys that each slice brings first, in order of slice."""
    first = rows.groupBy(key).agg(F.min(slice_).alias(slice_)).groupBy(slice_).agg(F.count("*").alias("n_new"))
    all_ = rows.select(slice_).distinct().join(first, slice_, "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)))
    return all_.withColumn("cumulative", F.sum("n_new").over(Window.orderBy(slice_).rowsBetween(Window.unboundedPreceding, 0)))


def overlap(rows: DataFrame, slice_: str, key: str, alarm: float = 0.5) -> DataFrame:
    """One row: rows over all slices, distinct keys, overlap, its ratio (0 if empty) and whether that is alarming."""
    per = rows.select(slice_, key).distinct().agg(F.count("*").alias("raw"), F.count_distinct(key).alias("united"))
    ratio = F.when(F.col("raw") > 0, (F.col("raw") - F.col("united")) / F.col("raw")).otherwise(0.0)
    return per.select("raw", "united", (F.col("raw") - F.col("united")).alias("overlapping"), F.round(ratio, 9).alias("ratio"), (ratio > alarm).alias("alarm"))


def shard(rows: DataFrame, order: list[str], index: int, count: int, within: list[str] | None = None) -> DataFrame:
    """Every count-th row, from the index-th on."""
    if count < 1 or not 0 <= index < count:
        raise ValueError("index must be from 0 to count - 1")
    at = rows.withColumn("__at", F.row_number().over(Window.partitionBy(*within).orderBy(*order)) - 1) if within else numbered(rows, order, "__at")
    return at.where(F.col("__at") % count == index).drop("__at")


def completeness(rows: DataFrame, keys: list[str], declared: str, collapsed: str) -> DataFrame:
    """Per key: collected, accounted (with collapsed ones), complete (null if nothing is declared) and missing."""
    by = rows.groupBy(*keys).agg(F.count("*").alias("collected"), F.max(declared).alias("declared"), F.max(collapsed).alias("collapsed"))
    accounted = F.col("collected") + F.coalesce("collapsed", F.lit(0))
    return by.select(*keys, "collected", "declared", accounted.alias("accounted"), (accounted >= F.col("declared")).alias("complete"), F.greatest(F.lit(0), F.col("declared") - accounted).alias("missing"))


def kind_counts(rows: DataFrame, kind: str, order: str) -> DataFrame:
    """Rows of each kind, most first, ties by first appearance."""
    return rows.groupBy(kind).agg(F.count("*").alias("n"), F.min(order).alias("first_at")).orderBy(F.desc("n"), "first_at")


def stable_reads(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """rows with ready: the last three readings are equal and above 0."""
    by = Window.partitionBy(*keys).orderBy(*order)
    same = (F.col(value) == F.lag(value, 1).over(by)) & (F.col(value) == F.lag(value, 2).over(by)) & (F.col(value) > 0)
    return rows.withColumn("ready", F.coalesce(same, F.lit(False)))


def micro_batches(rows: DataFrame, order: list[str], size: int = 20, within: list[str] | None = None) -> DataFrame:
    """rows with batch: the number of the group of ``size`` that they fall in, in order."""
    if within:
        return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*within).orderBy(*order)) - 1) / size))
    return numbered(rows, order, "__at").withColumn("batch", F.floor(F.col("__at") / size)).drop("__at")


def union_first(baselines: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """Rows of all baselines, of each key the first: of the earliest baseline that has it, then by order."""
    parts = [b.withColumn("__rank", F.lit(i)) for i, b in enumerate(baselines)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return keep_first(both, keys, ["__rank", *order]).drop("__rank")

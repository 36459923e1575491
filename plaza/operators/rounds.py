"""How a round of collection went, from its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Why a list was read no further.
STOPS = ("end_marker", "early_stop", "stable", "gave_up", "max_rounds")
TRUNCATED, TRUSTED = ("max_rounds", "gave_up"), ("end_marker", "early_stop")


def scroll_outcome(log: DataFrame, keys: list[str], stable_rounds: int = 3, max_nudges: int = 2, max_rounds: int = 500) -> DataFrame:
    """(keys, stop_reason, rounds, total, nudges, truncated, suspicious): the state machine of a scrolled list, replayed over its log.

    log(keys, round_no, new, at_end, early): round 0 is what the first screen had; at_end and
    early are asked before a round scrolls, in this order. ``stable_rounds`` rounds without
    anything new in a row call for a nudge, after which counting starts anew; when the nudges
    are used up the list is given up (stable, if there were none). A log that ends before has a
    null reason. As windows: the rounds at which it is stuck are every stable_rounds-th of a run
    without new rows, and the one after the last nudge stops.
    """
    by = Window.partitionBy(*keys).orderBy("round_no")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    rows = log.withColumn("__run", F.sum(F.when((F.col("new") > 0) | (F.col("round_no") == 0), 1).otherwise(0)).over(upto))
    at = F.row_number().over(Window.partitionBy(*keys, "__run").orderBy("round_no")) - 1  # rounds since the last with something new
    rows = rows.withColumn("__stuck", ((F.col("new") == 0) & (F.col("round_no") > 0) & (at % stable_rounds == 0) & (at > 0)).cast("int"))
    rows = rows.withColumn("__stucks", F.sum("__stuck").over(upto)).withColumn("__sum", F.sum("new").over(upto))
    scrolled = F.col("round_no") > 0
    given_up = F.col("__stuck").cast("boolean") & (F.col("__stucks") == max_nudges + 1)
    stop = (
        F.when(scrolled & F.col("at_end"), F.lit(0)).when(scrolled & F.col("early"), F.lit(1)).when(given_up, F.lit(3 if max_nudges else 2)).when(F.col("round_no") >= max_rounds, F.lit(4))
    )
    before = F.col("round_no") - (stop <= 1).cast("int")
    used = F.least(F.col("__stucks") - F.when(stop <= 1, F.col("__stuck")).otherwise(0), F.lit(max_nudges))
    total = F.col("__sum") - F.when(stop <= 1, F.col("new")).otherwise(0)
    ended = rows.withColumn("__stop", F.when(stop.isNotNull(), F.struct(stop.alias("why"), before.alias("rounds"), total.alias("total"), F.when(stop == 0, 0).otherwise(used).alias("nudges"))))
    first = ended.groupBy(*keys).agg(F.min_by("__stop", F.when(F.col("__stop").isNotNull(), F.col("round_no"))).alias("s"), F.max("round_no").alias("last"), F.max_by("__sum", "round_no").alias("sum"), F.least(F.max("__stucks"), F.lit(max_nudges)).alias("stucks"))
    why = F.element_at(F.array(*map(F.lit, STOPS)), (F.col("s.why") + 1).cast("int"))
    out = first.select(*keys, F.when(F.col("s").isNotNull(), why).alias("stop_reason"), F.coalesce("s.rounds", "last").cast("long").alias("rounds"), F.coalesce("s.total", "sum").cast("long").alias("total"), F.coalesce("s.nudges", "stucks").cast("long").alias("nudges"))
    return out.withColumn("truncated", F.col("stop_reason").isin(*TRUNCATED)).withColumn("suspicious", ~F.col("stop_reason").isin(*TRUSTED))


def comment_completeness(rounds: DataFrame) -> DataFrame:
    """rounds(declared, collected, no_comments, opened, inline, container_found, stuck, truncated) with missing and ok.

    missing: declared and not collected; 0 if nothing is declared. ok: only sure failures fail,
    and having no comments is none.
    """
    failed = ~(F.col("opened") | F.col("inline")) | (F.col("collected") == 0) | ~F.col("container_found") | F.col("stuck") | F.coalesce("truncated", F.lit(False))
    return rounds.withColumn("missing", F.greatest(F.lit(0), F.coalesce(F.col("declared") - F.col("collected"), F.lit(0)))).withColumn("ok", F.col("no_comments") | ~failed)


def content_ok(has_item: Column, has_text: Column, truncated: Column) -> Column:
    return F.coalesce(has_item & has_text & ~truncated, F.lit(False))


def question_ok(title: Column) -> Column:
    return F.coalesce(title != "", F.lit(False))


def empty_result(text: Column, markers: tuple[str, ...]) -> Column:
    """Whether a result page says that nothing was found; what it shows instead is still collected."""
    hit = F.lit(False)
    for m in markers:
        hit = hit | F.contains(text, F.lit(m))
    return F.coalesce(hit, F.lit(False))


def cost_limit(rows: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """The first ``limit`` rows in order; all if it is null."""
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def cross_check_report(checked: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, checked, suspects): suspects are told, not dropped. checked(checked, agree) as ``collection.cross_check`` has them."""
    return checked.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("checked").alias("checked"), F.count_if(~F.col("agree")).alias("suspects"))


def known_gaps(report: DataFrame) -> DataFrame:
    """report(unresolved_authors, unresolved_questions) with gaps: one line about both, null if there are none."""
    said = [F.when(F.col(c) > 0, F.concat(F.lit(f"{what}: "), F.col(c))) for c, what in (("unresolved_authors", "author_id"), ("unresolved_questions", "question_id"))]
    return report.withColumn("gaps", F.nullif(F.concat_ws("; ", *said), F.lit("")))

"""Mixing sources to target weights, in DataFrame operations only.

Weights are the token shares of the sources raised to an exponent (the inverse temperature)
and normalised. The exponent is bisected: 1 keeps the shares, 0 evens them out; the least
exponent is sought at which no source repeats more than a limit, or the greatest at which the
entropy reaches a target. The weights are realised as budgeted block permutations: a source
runs through whole permutations of its documents (blocks) until its token budget is used up;
the last block is cut at the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPETITION = 2.0
#: Levels of bisection that one aggregation decides, and how often that is done.
LEVELS, ROUNDS = 6, 6
#: About so many documents to a bucket of a permutation.
BUCKET_ROWS = 20_000


def tokens_of(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_shares(docs: DataFrame, source: str, tokens: str) -> DataFrame:
    """(source, docs, tokens, share) of sources with tokens; a null source is a source of its own."""
    by = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("docs"), F.sum(tokens).alias("tokens")).where("tokens > 0")
    total = by.agg(F.sum("tokens").alias("total"))
    return by.crossJoin(F.broadcast(total)).select("source", "docs", "tokens", (F.col("tokens") / F.col("total")).alias("share"))


def find_exponent(shares: DataFrame, max_repetition: float = MAX_REPETITION, target_entropy: float | None = None, budget: int | None = None) -> float:
    """The exponent in [0, 1], by bisection; only pass or fail of each tried exponent reaches the driver.

    With ``target_entropy`` (nats): the greatest exponent whose entropy is that high (0 if none
    is). Otherwise the least exponent at which ``weight * budget <= max_repetition * tokens``
    holds for each source (1 if none does, as when the budget is over max_repetition times all
    tokens). ``budget`` defaults to all tokens. No sources: 1.
    """
    low, high, cells = 0.0, 1.0, 1 << LEVELS
    spent = shares.agg(F.sum("tokens").cast("double").alias("budget")) if budget is None else shares.sparkSession.range(1).select(F.lit(float(budget)).alias("budget"))
    budgeted = shares.crossJoin(F.broadcast(spent))
    for _ in range(ROUNDS):
        at = [low + (high - low) * i / cells for i in range(cells + 1)]
        tried = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(at[i]).alias("a")) for i in range(1, cells))))
        powered = budgeted.select("share", "tokens", "budget", tried.alias("t")).select("tokens", "budget", "t.i", F.pow("share", "t.a").alias("p"))
        if target_entropy is not None:
            held = F.log(F.sum("p")) - F.sum(F.col("p") * F.log("p")) / F.sum("p") >= target_entropy
        else:
            held = F.max(F.col("p") * F.col("budget") / F.col("tokens")) <= max_repetition * F.sum("p")
        ok = {r.i: r.ok for r in powered.groupBy("i").agg(held.alias("ok")).collect()}
        if not ok:
            return 1.0
        a, b = 0, cells
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (mid, b) if ok[mid] == (target_entropy is not None) else (a, mid)
        low, high = at[a], at[b]
    return low if target_entropy is not None else high


def _place(block: Column, seed: int, key: Column, digest: Column) -> Column:
    """A row's place in a block's permutation, in [0, 1), from an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), F.coalesce(key.cast("string"), F.lit("")), digest)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", max_repetition: float = MAX_REPETITION, target_entropy: float | None = None, budget: int | None = None, seed: int = 0) -> DataFrame:
    """The columns of docs, and mix_block (0, 1, ...), mix_order (0 to 1) and mix_tokens: a row for each time a document is drawn.

    Sort by mix_order to read all sources interleaved at their weights. A source with weight w
    gets round(w * budget) tokens (budget: all tokens unless given): whole blocks as often as
    they fit and the start of another, up to the document that reaches the budget. A block's
    permutation is in order of an md5 of seed, block, key and text; rows equal in key and text
    are drawn together. A null source is a source of its own, a null key counts as an empty
    one. Documents without words have no tokens and come with each block they lie in. Existing
    mix_ columns are replaced; an empty table, or one without words, gives no rows.

    Documents aren't shuffled: of each, source, key, digest and tokens are written once; from
    these the last place that is drawn of each source's last block is found, first by sums
    over ranges of about BUCKET_ROWS rows, then inside one range. Rows are kept by comparing
    with that place.
    """
    names = [c for c in docs.columns if c not in ("mix_block", "mix_order", "mix_tokens")]
    own = F.md5(F.coalesce(F.col(text), F.lit("")))
    thin = stored(docs.select(F.col(source).alias("source"), F.col(key).alias("key"), own.alias("digest"), tokens_of(text).alias("tokens")), "thin")
    shares = stored(source_shares(thin, "source", "tokens"), "shares")
    exponent = find_exponent(shares, max_repetition, target_entropy, budget)
    total = shares.agg(F.sum(F.pow("share", F.lit(exponent))).alias("z"), F.sum("tokens").alias("sum"))
    quota = F.round(F.pow("share", F.lit(exponent)) / F.col("z") * (F.col("sum") if budget is None else F.lit(budget))).cast("long")
    plan = stored(
        shares.crossJoin(F.broadcast(total))
        .withColumn("quota", quota)
        .where("quota > 0")
        .select(F.col("source").alias("__source"), F.col("tokens").alias("__all"), F.col("quota").alias("__quota"), F.expr("int((quota + tokens - 1) div tokens) - 1").alias("__last"), F.expr(f"int(docs div {BUCKET_ROWS}) + 1").alias("__buckets")),
        "plan",
    )
    # the last block of each source: which range of places holds the cut, and where in it
    placed = thin.join(plan, thin["source"].eqNullSafe(plan["__source"])).withColumn("place", _place(F.col("__last"), seed, F.col("key"), F.col("digest")))
    placed = placed.select("__source", F.expr("__quota - __last * __all").alias("left"), F.floor(F.col("place") * F.col("__buckets")).alias("bucket"), "place", "tokens")
    sums = placed.groupBy("__source", "left", "bucket").agg(F.sum("tokens").alias("sum"))
    upto = F.sum("sum").over(Window.partitionBy("__source").orderBy("bucket"))
    cut_at = sums.withColumn("upto", upto).where("upto >= left and upto - sum < left").select(F.col("__source").alias("s"), F.col("bucket").alias("b"), F.expr("left - upto + sum").alias("rest"))
    cut_at = stored(cut_at, "cuts")
    range_ = placed.join(cut_at, placed["__source"].eqNullSafe(cut_at["s"]) & (placed["bucket"] == cut_at["b"])).select("s", "place", "tokens", "rest")
    reached = F.sum("tokens").over(Window.partitionBy("s").orderBy("place"))  # rows of one place together
    cuts = range_.withColumn("reached", reached).where("reached >= rest").groupBy("s").agg(F.min("place").alias("__cut"))
    plan = stored(plan.join(cuts, plan["__source"].eqNullSafe(cuts["s"])).select("__source", "__all", "__quota", "__last", "__cut"), "plan")
    drawn = docs.select(*names, tokens_of(text).alias("mix_tokens"), own.alias("__digest")).join(plan, docs[source].eqNullSafe(plan["__source"]))
    drawn = drawn.withColumn("mix_block", F.explode(F.sequence(F.lit(0), F.col("__last")))).withColumn("__place", _place(F.col("mix_block"), seed, F.col(key), F.col("__digest")))
    order = (F.col("mix_block") + F.col("__place")) * F.col("__all") / F.greatest(F.col("__quota"), (F.col("__last") + F.col("__cut")) * F.col("__all"))
    return drawn.where("mix_block < __last or __place <= __cut").select(*names, "mix_block", F.least(order, F.lit(1.0)).alias("mix_order"), "mix_tokens")

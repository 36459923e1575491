"""One ordered log of commands of all kinds, folded by key into the next version of a table.

The log may interleave inserts, claims, patches, overwrites, marks and bumps; the result is that
of applying them one after another. Rows are never deleted, so a key exists from its first
creating command on, or from the start. That makes the fold an aggregation that combines before
the shuffle, however hot a key is: of each key the first creating command, and of each column the
last write. A write before the creation of its key did nothing; as the creation wrote the whole
row, the last write of a column counts if it comes later, else the creator's value does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a command does to a key that is there, and to one that isn't:
#: insert, claim   nothing                                | the row is made, of its values
#: replace         all columns but ``keep``, nulls too    | the row is made
#: upsert          the columns that aren't null           | the row is made, others null
#: patch           the columns that aren't null           | nothing
#: mark            the flag goes from false to true once  | nothing
#: bump            the counter goes up by one             | nothing
CREATING, WRITING = ("insert", "claim", "replace", "upsert"), ("replace", "upsert", "patch")
KINDS = (*CREATING, "patch", "mark", "bump")


def apply_log(current: DataFrame, log: DataFrame, keys: list[str], keep: tuple[str, ...] = (), flag: str | None = None, counter: str | None = None, claimed_null: tuple[str, ...] = (), forced: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(next version, (ord, keys, op) of the commands that won), for log(ord, op, keys, columns of current).

    ``ord`` is a total order. Won have: an insert, claim, replace or upsert that made its row, and
    the first mark that found the flag false or null. Columns of current that the log lacks count
    as null. ``claimed_null``: columns that a claim leaves null whatever it says; ``forced``: columns
    that each replace, upsert or patch sets to a value. A counter that is null counts from 0. A row
    with a null in a key, or an unknown op, is an error when it is read; an empty log changes nothing.
    """
    forced = forced or {}
    values = [c for c in current.columns if c not in keys]
    known = F.col("op").isin(*KINDS) & ~F.isnull(F.concat(*(F.col(k).cast("string") for k in keys)))
    typed = [F.col(c).cast(current.schema[c].dataType).alias(c) if c in log.columns else F.lit(None).cast(current.schema[c].dataType).alias(c) for c in values]
    rows = log.select("ord", F.when(F.coalesce(known, F.lit(False)), F.col("op")).otherwise(F.raise_error(F.concat(F.lit("no command: ord "), F.col("ord")))).alias("op"), *(F.col(k).cast(current.schema[k].dataType).alias(k) for k in keys), *typed)
    creates, writes = F.col("op").isin(*CREATING), F.col("op").isin(*WRITING)

    def given(c: str) -> Column:
        """The command writes this column of a row that is there."""
        if c in forced:
            return writes
        replaces = (F.col("op") == "replace") if c not in keep else F.lit(False)
        patches = F.col("op").isin("upsert", "patch") & F.col(c).isNotNull()
        return replaces | patches

    value = lambda c: forced[c].cast(current.schema[c].dataType) if c in forced else F.col(c)
    made = F.struct("ord", "op", *(F.when((F.col("op") == "claim"), F.lit(None)).otherwise(F.col(c)).alias(c) if c in claimed_null else F.when(writes, value(c)).otherwise(F.col(c)).alias(c) for c in values))
    last = [F.max_by(F.struct("ord", value(c).alias("v")), F.when(given(c), F.col("ord"))).alias(f"__{c}") for c in values]
    folded = rows.groupBy(*keys).agg(F.min_by(made, F.when(creates, F.col("ord"))).alias("__made"), *last)
    there = current.withColumn("__there", F.lit(True))
    both = there.join(folded, keys, "full").withColumn("__from", F.when(F.col("__there"), F.lit(None)).otherwise(F.col("__made.ord")))  # null: it was there
    alive = F.col("__there") | F.col("__made").isNotNull()

    def result(c: str) -> Column:
        later = F.col(f"__{c}").isNotNull() & (F.col("__from").isNull() | (F.col(f"__{c}.ord") > F.col("__from")))
        return F.when(later, F.col(f"__{c}.v")).when(F.col("__there"), F.col(c)).otherwise(F.col(f"__made.{c}")).alias(c)

    after = both.where(alive).select(*keys, *(result(c) for c in values), "__from", "__there", F.col("__made.op").alias("__op"))
    won = after.where(F.col("__there").isNull()).select(F.col("__from").alias("ord"), *keys, F.col("__op").alias("op"))
    if flag or counter:
        # marks and bumps count from the creation of their key on: each meets its key's row, and is summed up before the next shuffle
        born = after.select(*keys, F.col("__from").alias("__born"))
        acts = rows.where(F.col("op").isin("mark", "bump")).select("ord", "op", *keys).join(born, keys).where(F.col("__born").isNull() | (F.col("ord") > F.col("__born")))
        sums = acts.groupBy(*keys).agg(F.min(F.when(F.col("op") == "mark", F.col("ord"))).alias("__mark"), F.count_if(F.col("op") == "bump").alias("__bumps"))
        after = after.join(sums, keys, "left")
        if flag:
            wins = F.col("__mark").isNotNull() & ~F.coalesce(F.col(flag), F.lit(False))
            won = won.unionByName(after.where(wins).select(F.col("__mark").alias("ord"), *keys, F.lit("mark").alias("op")))
            after = after.withColumn(flag, F.when(wins, True).otherwise(F.col(flag)))
        if counter:
            more = F.coalesce("__bumps", F.lit(0))
            after = after.withColumn(counter, F.when(more > 0, F.coalesce(counter, F.lit(0)) + more).otherwise(F.col(counter)).cast(current.schema[counter].dataType))
    return after.select(*current.columns), won.select("ord", *keys, "op")

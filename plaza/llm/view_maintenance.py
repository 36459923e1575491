"""Incremental maintenance of an aggregated join: a cube of lifetime classes.

Rows of the base tables are there from one batch to another: a row is inserted in batch ``start``
and deleted in batch ``end`` (the half-open interval is its lifetime). A joined row lives while all
of its rows do, from the latest start to the earliest end. With B batches there are at most
B (B + 1) / 2 different lifetimes, so instead of replaying the batches the joined rows are
aggregated once by (group, start, end): a class holds a count, sums, least values and the sets of
ids that are to be counted. The classes, few for each group, are then expanded to the batches in
which they live, and combined.

An id set grows with the input, so it is kept the other way round, as rows (group, id) with the
classes in which the id occurs as bits: no set ever lies in one row. All four kinds of measures
come from one shuffle, in which the rows of a task are combined first: a hot group or id has one
row a task. A cube is a table of partial aggregates; two of them are merged by the same
aggregation, so new joined rows need no second look at the old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a cube after those of the group: whose set it is ('' for a class's measures), the id in it, the classes as bits, the class, count, sum and least value.
CUBE = ["of", "id", "classes", "class", "n", "total", "least"]
#: A class has a bit of a long.
MAX_BATCHES = 10


#: More nations than this aren't broadcast.
MAX_NATIONS = 10_000


def with_lifetime(rows: DataFrame, name: Column, batches: int, start: str, end: str) -> DataFrame:
    """rows with their start and end, from the crc32 h of a name: inserted in h mod B, deleted in h div B mod B if that is later; otherwise always there, as are rows without a name."""
    h, a, d = F.col(f"{start}_h"), F.col(f"{start}_a"), F.col(f"{start}_d")
    hashed = rows.withColumn(f"{start}_h", F.crc32(name.cast("binary")))
    drawn = hashed.withColumns({f"{start}_a": (h % batches).cast("int"), f"{start}_d": (F.floor(h / F.lit(batches)) % batches).cast("int")})
    return drawn.withColumns({start: F.when(a < d, a).otherwise(0), end: F.when(a < d, d).otherwise(batches)}).drop(f"{start}_h", f"{start}_a", f"{start}_d")


def _number(start: Column, end: Column, batches: int) -> Column:
    """The number of a class: classes by start, then by end."""
    return (start * batches - F.floor(start * (start - 1) / 2).cast("int") + end - start - 1).cast("int")


def _classes(batches: int) -> list[tuple[int, int]]:
    return [(a, d) for a in range(batches) for d in range(a + 1, batches + 1)]


def lifetime_cube(joined: DataFrame, group: list[str], value: str, ids: list[str], batches: int = 7, start: str = "start", end: str = "end") -> DataFrame:
    """The cube of joined rows: measures by (group, class), id sets by (group, column, id) with their classes.

    value is a long; where it is null the row counts but adds nothing. Rows with a null in the
    group or an empty lifetime drop out; null ids are in no set; equal rows all count.
    """
    if not 0 < batches <= MAX_BATCHES:
        raise ValueError(f"1 to {MAX_BATCHES} batches")
    known = joined.where(F.col(start) < F.col(end)).where(" and ".join(f"`{g}` is not null" for g in group))
    c = _number(F.col(start), F.col(end), batches)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), c)
    none = F.lit(None).cast("long")
    own = F.struct(F.lit("").alias("of"), none.alias("id"), c.alias("class"), none.alias("classes"), F.lit(1).cast("long").alias("n"), F.col(value).cast("long").alias("value"))
    sets = [F.when(F.col(i).isNotNull(), F.struct(F.lit(i).alias("of"), F.col(i).cast("long").alias("id"), F.lit(None).cast("int").alias("class"), bit.alias("classes"), none.alias("n"), none.alias("value"))) for i in ids]
    rows = known.select(*group, F.explode(F.filter(F.array(own, *sets), lambda x: x.isNotNull())).alias("x")).select(*group, "x.*")
    return rows.groupBy(*group, "of", "id", "class").agg(F.bit_or("classes").alias("classes"), F.sum("n").alias("n"), F.sum("value").alias("total"), F.min("value").alias("least")).select(*group, *CUBE)


def merge_cubes(first: DataFrame, second: DataFrame, group: list[str]) -> DataFrame:
    """The cube of the rows of both."""
    rows = first.unionByName(second)
    return rows.groupBy(*group, "of", "id", "class").agg(F.bit_or("classes").alias("classes"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least")).select(*group, *CUBE)


def view_after_batches(cube: DataFrame, group: list[str], ids: list[str], batches: int = 7) -> DataFrame:
    """The view after each batch: batch, the group, n, total, least and the number of different ids of each set. Empty groups have no row.

    Each class adds to the batches it lives in, and each id to those in which one of its classes
    lives: sums by group that a task combines before the shuffle, a row a group.
    """
    one = lambda k: 1 << k
    made = []
    for b in range(batches):
        alive = sum(one(k) for k, (a, d) in enumerate(_classes(batches)) if a <= b < d)
        lives = (F.call_function("shiftleft", F.lit(1).cast("long"), F.coalesce("class", F.lit(0))).bitwiseAND(F.lit(alive)) != 0) & (F.col("of") == "")
        occurs = F.col("classes").bitwiseAND(F.lit(alive)) != 0
        made.append(F.struct(
            F.lit(b).alias("batch"), F.sum(F.when(lives, F.col("n"))).alias("n"), F.sum(F.when(lives, F.col("total"))).alias("total"), F.min(F.when(lives, F.col("least"))).alias("least"),
            *(F.sum(F.when(occurs & (F.col("of") == i), 1).otherwise(0)).cast("long").alias(f"n_{i}") for i in ids),
        ))
    return cube.groupBy(*group).agg(F.array(*made).alias("views")).select(*group, F.explode("views").alias("x")).select("x.batch", *group, "x.n", "x.total", "x.least", *(f"x.n_{i}" for i in ids)).where("n > 0")


# --- the shop's revenue by region and day ---


def _finite(c: str) -> Column:
    """Not-a-number and infinite amounts count as null."""
    return F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c))


def shop_rows(clients: DataFrame, sales: DataFrame, lines: DataFrame, vendors: DataFrame, nations: DataFrame, batches: int = 7) -> DataFrame:
    """The joined rows of the shop: region, part (day), client_id, item_id, revenue, start and end.

    Each join is a shuffle by its key, which Spark can split where a key is hot, as the joined rows
    go on to a shuffle by another key. That is asked for: a table that grows isn't broadcast,
    however small it is here. Only nations are, if they are MAX_NATIONS at most. Repeated ids join
    as in SQL; null ids join with nothing. Amounts that are null or not finite drop the line; a
    null discount leaves a line without revenue.
    """
    region = nations.select(F.col("n_nationkey").cast("int").alias("nation_id"), F.col("n_regionkey").cast("long").alias("region")).where("nation_id is not null and region is not null")
    region = F.broadcast(region) if nations.limit(MAX_NATIONS + 1).count() <= MAX_NATIONS else region.hint("merge")
    days = F.datediff(F.to_date("sold_at"), F.lit("1970-01-01").cast("date")).cast("long")
    who = with_lifetime(clients.select("client_id", "nation_id").where("client_id is not null"), F.concat(F.lit("c"), "client_id"), batches, "c0", "c1").join(region, "nation_id").drop("nation_id")
    dated = with_lifetime(sales.select("sale_id", "client_id", days.alias("part")).where("part is not null and sale_id is not null"), F.concat(F.lit("s"), "sale_id"), batches, "s0", "s1")
    sold = dated.join(who.hint("merge"), "client_id").select("sale_id", "client_id", "part", "region", F.greatest("s0", "c0").alias("s0"), F.least("s1", "c1").alias("s1")).where("s0 < s1")
    amount, discount = F.floor(100 * _finite("amount") + 0.5), F.floor(100 * _finite("discount") + 0.5)
    priced = lines.where(_finite("amount").isNotNull()).where("sale_id is not null and vendor_id is not null").select("sale_id", "line_no", "vendor_id", "item_id", (amount * (100 - discount)).cast("long").alias("revenue"))
    bought = with_lifetime(priced, F.concat(F.lit("l"), "sale_id", F.lit(":"), "line_no"), batches, "l0", "l1").drop("line_no")
    rows = bought.join(sold.hint("merge"), "sale_id").select("vendor_id", "item_id", "revenue", "client_id", "part", "region", F.greatest("s0", "l0").alias("start"), F.least("s1", "l1").alias("end")).where("start < end")
    seller = vendors.select("vendor_id", "nation_id").where("vendor_id is not null").join(region.withColumnRenamed("region", "its"), "nation_id").drop("nation_id")
    return rows.join(seller.hint("merge"), "vendor_id").where("region = its").select("region", "part", "client_id", "item_id", "revenue", "start", "end")

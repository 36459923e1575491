"""Tables as immutable versions with a pointer, and keyed changes to them.

Parquet has no MERGE: a change is folded to one row a key, joined with the current version and
written as the next one. One writer a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import numbered


def insert_ignore(current: DataFrame, changes: DataFrame, keys: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """(next version, inserted rows): the first change of each key that isn't there."""
    first = changes.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("__n = 1").drop("__n")
    new = first.join(current.select(*keys), keys, "left_anti").select(*current.columns)
    return current.unionByName(new), new


def replace(current: DataFrame, changes: DataFrame, keys: list[str], order: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Upsert of whole rows: the last change of each key wins, nulls too; columns in ``keep`` stay as they are in rows that exist."""
    values = [c for c in current.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("__new"))
    both = current.withColumn("__old", F.lit(True)).join(last, keys, "full")
    pick = [F.when(F.col("__new").isNull() | (F.col("__old") if c in keep else F.lit(False)), F.col(c)).otherwise(F.col(f"__new.{c}")).alias(c) for c in values]
    return both.select(*keys, *pick).select(*current.columns)


def patch(current: DataFrame, changes: DataFrame, keys: list[str], order: str, fields: list[str], forced: dict[str, Column] | None = None, insert_missing: bool = True) -> DataFrame:
    """Upsert of given fields: the last non-null value of each wins, as if the patches were applied one after another; ``forced`` columns are set on every row hit."""
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__{c}") for c in fields]  # combined before the shuffle
    folded = changes.groupBy(*keys).agg(*latest, F.lit(True).alias("__hit"))
    both = current.join(folded, keys, "full" if insert_missing else "left")
    forced = forced or {}

    def value(c: str) -> Column:
        if c in forced:
            return F.when(F.col("__hit"), forced[c]).otherwise(F.col(c)).alias(c)
        return F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in fields else F.col(c)

    return both.select(*(F.col(c) if c in keys else value(c) for c in current.columns))


def compare_and_set(current: DataFrame, ids: DataFrame, key: str, flag: str) -> tuple[DataFrame, DataFrame]:
    """(next version, winners): the flag goes from false to true once; ids that are unknown or already set win nothing."""
    asked = ids.select(key).distinct().withColumn("__asked", F.lit(True))
    both = current.join(asked, key, "left")
    wins = F.col("__asked").isNotNull() & ~F.coalesce(F.col(flag), F.lit(False))
    after = both.withColumn(flag, F.col(flag) | F.coalesce(wins, F.lit(False))).select(*current.columns)
    return after, both.where(wins).select(key)


def with_ids(rows: DataFrame, current: DataFrame, key: str, order: str) -> DataFrame:
    """rows with surrogate ids that continue the table's, in order."""
    top = current.agg(F.coalesce(F.max(key), F.lit(0)).alias("__top"))  # one row
    return numbered(rows, [order], key).crossJoin(F.broadcast(top)).withColumn(key, F.col("__top") + F.col(key) + 1).drop("__top")


def content_id(url: Column) -> Column:
    """A name-based id, the same on every retry."""
    h = F.sha2(url, 256)
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


class Conflict(Exception):
    """Another writer has made the version that was to be made."""


class Store:
    """Versioned tables under a root that driver and executors share.

    A version is a folder of Parquet and a mark, a small file that has the version's number for
    its name and the folder's name in it. A mark is made only if there is none of its number, so of
    two writers that read the same version one gets an error and must read again. The greatest
    mark is the current one. A mark without content is of a writer that died, and doesn't count.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.seen: dict[str, int] = {}

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def marks(self, table: str) -> list[int]:
        """The numbers of a table's marks, oldest first."""
        path, fs = self._path(table, "marks")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit()) if fs.exists(path) else []

    def _folder(self, table: str, number: int) -> str | None:
        path, fs = self._path(table, "marks", f"{number:012d}")
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode() or None
        finally:
            stream.close()

    def version(self, table: str) -> str | None:
        """The folder of the current version."""
        return next((v for n in reversed(self.marks(table)) if (v := self._folder(table, n))), None)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The current version; an empty table if there is none. The next commit follows it."""
        marks = self.marks(table)
        self.seen[table] = marks[-1] if marks else 0
        now = next((v for n in reversed(marks) if (v := self._folder(table, n))), None)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/{now}") if now else self.spark.createDataFrame([], schema)

    def commit(self, table: str, rows: DataFrame) -> str:
        """Writes the version after the one that was read, then its mark; if there is one meanwhile, Conflict."""
        marks = self.marks(table)
        number = self.seen.get(table, marks[-1] if marks else 0) + 1
        name = f"v_{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{table}/{name}")
        path, fs = self._path(table, "marks", f"{number:012d}")
        try:
            stream = fs.create(path, False)
        except Exception as e:
            if fs.exists(path):
                raise Conflict(f"{table} has a version {number} by another writer") from e
            raise
        stream.write(bytearray(name.encode()))
        stream.close()
        self.seen[table] = number
        return name

"""Logs as streams: append-only sources, deduplication across restarts, and early stop as state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..shared import written


def follow_log(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class _FirstOnly(StatefulProcessor):
    """Emits the first row of a key, once. Its state is only that the key is known."""

    def __init__(self, order: list[str] | None) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", T.StructType([T.StructField("known", T.BooleanType())]))

    def handleInitialState(self, key: tuple, initial: pd.DataFrame, timers: object) -> None:  # noqa: N802
        self.known.update((True,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:  # noqa: N802
        if self.known.exists():
            return
        best = None
        for part in rows:  # one batch of rows at a time: a hot key's are never all in memory
            both = part if best is None else pd.concat([best, part])
            best = (both.sort_values(self.order, kind="stable") if self.order else both).head(1)
        if best is not None:
            self.known.update((True,))
            yield best

    def close(self) -> None:
        pass


def ingest_new(stream: DataFrame, key: str, known: DataFrame | None, sink: str, checkpoint: str, order: list[str] | None = None) -> StreamingQuery:
    """Writes rows whose key hasn't come before, the first by ``order`` of a batch; a restarted query goes on where it stopped.

    The keys are state of the query, in the checkpoint. known(key) fills it before the first batch
    (what a sink holds that was made in another way) and isn't read again: a later batch costs
    what it brings, however large the sink is. The sink's own log makes a batch that is replayed
    count once. Rows without a key aren't written.
    """
    spark = stream.sparkSession
    filled = known.where(F.col(key).isNotNull()).select(key).distinct().groupBy(key) if known is not None else None
    fresh = stream.where(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(_FirstOnly(order), stream.schema, "append", "none", filled)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # a query keeps the settings it was started with
    try:
        return fresh.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


class Baseline:
    """A table as it was at one stated moment, for all batches of a round: written once, read again only by ``renew``.

    Rows that come to the table meanwhile are seen from the next renewal on, so all batches of a
    round are compared with the same rows, whatever the round itself writes.
    """

    def __init__(self, table: Callable[[], DataFrame], columns: list[str]) -> None:
        self.table, self.columns = table, columns
        self.renew()

    def renew(self) -> None:
        self.rows = written(self.table().select(*self.columns).distinct(), "baseline")

    def known(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """rows, a stream's too, with is_known: whether the baseline has their keys. Null keys aren't known."""
        there = self.rows.select(*keys).distinct().withColumn("is_known", F.lit(True))
        return rows.join(there, keys, "left").withColumn("is_known", F.coalesce("is_known", F.lit(False)))


def early_stop(stream: DataFrame, key: str, position: str, known: str, length: int = 5) -> DataFrame:
    """(key, stop_pos) once for each key, when ``length`` known rows in a row have come; rows of a batch are read by position."""

    def run(keys: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        in_a_row, stopped = state.get if state.exists else (0, False)
        rows = pd.concat(list(parts)).sort_values(position)
        out = []
        for pos, is_known in zip(rows[position], rows[known]):
            if stopped:
                break
            in_a_row = in_a_row + 1 if is_known else 0
            if in_a_row == length:
                stopped = True
                out.append((keys[0], int(pos)))
        state.update((in_a_row, stopped))
        yield pd.DataFrame(out, columns=[key, "stop_pos"])

    schema = T.StructType([stream.schema[key], T.StructField("stop_pos", T.LongType())])
    return stream.groupBy(key).applyInPandasWithState(run, schema, "in_a_row int, stopped boolean", "append", "NoTimeout")

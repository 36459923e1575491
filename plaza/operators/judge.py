"""Judging: an injectable function from text to verdict, and the deterministic rule judge."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, as_completed, wait

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import replies
from ..functions.urls import once
from ..schema import EVENT_STANCES, PLATFORM_STANCES, RISKS


def rule_judge(text: Column, rules: list[tuple[str, bool, str, str]], fallback: tuple[bool, str, str]) -> Column:
    """struct<is_relevant, platform_stance, risk_level> of the first rule whose needle the text holds."""

    def row(relevant: bool, stance: str, risk: str) -> Column:
        return F.struct(F.lit(relevant).alias("is_relevant"), F.lit(stance).alias("platform_stance"), F.lit(risk).alias("risk_level"))

    out = row(*fallback)
    for needle, *verdict in reversed(rules):
        out = F.when(F.contains(text, F.lit(needle)), row(*verdict)).otherwise(out)
    return out


def judge_each(rows: DataFrame, key: str, text: str, judge: Callable[[str], str], partitions: int | None = None, concurrency: int = 8) -> DataFrame:
    """(key, ok, reply, error): one request a row; a failure is a row, blank texts are refused before the call.

    A partition keeps ``concurrency`` requests open, never more: it waits for answers, not for
    cores. Rows come as they are answered, in no order.
    """

    def one(k: object, t: str | None) -> tuple:
        try:
            if not (t or "").strip():
                raise ValueError("blank text")
            return k, True, judge(t), None
        except Exception as e:  # noqa: BLE001  one failure never fails the batch
            return k, False, None, f"{type(e).__name__}: {e}"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda done: pd.DataFrame([f.result() for f in done], columns=[key, "ok", "reply", "error"])
        with ThreadPoolExecutor(concurrency) as pool:
            open_: set[Future] = set()
            for k, t in ((k, t) for part in parts for k, t in zip(part[key], part[text], strict=True)):
                if len(open_) >= concurrency:
                    done, open_ = wait(open_, return_when=FIRST_COMPLETED)
                    yield frame(done)
                open_.add(pool.submit(one, k, t))
            for f in as_completed(open_):
                yield frame([f])

    chosen = rows.select(key, text)
    chosen = chosen.repartition(partitions) if partitions else chosen
    return chosen.mapInPandas(run, T.StructType([rows.schema[key], *T.StructType.fromDDL("ok boolean, reply string, error string").fields]))


def judge_into(rows: DataFrame, key: str, text: str, judge: Callable[[str], str], path: str, waves: int = 16, partitions: int | None = None, concurrency: int = 8) -> DataFrame:
    """The judgments of all rows, kept in the table at ``path`` as they come; a run that is killed goes on without asking again.

    Rows are dealt to waves by the hash of their key, and each wave is one append to the table, so
    that at most a wave is lost. What the table has isn't asked again, failures are: they may
    pass. Of several judgments of a key one that succeeded counts, else the last wave's.
    """
    spark = rows.sparkSession
    schema = T.StructType([rows.schema[key], *T.StructType.fromDDL("ok boolean, reply string, error string, run long").fields])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = lambda: folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    read = lambda: spark.read.schema(schema).parquet(path) if there() else spark.createDataFrame([], schema)
    number = (read().agg(F.max("run")).first()[0] or 0) + 1
    for n in range(waves):
        wave = rows.where(F.pmod(F.xxhash64(key), F.lit(waves)) == n).join(read().where("ok").select(key), key, "left_anti")
        judge_each(wave, key, text, judge, partitions, concurrency).withColumn("run", F.lit(number).cast("long")).write.mode("append").parquet(path)
    best = read().groupBy(key).agg(F.max_by(F.struct("ok", "reply", "error"), F.struct("ok", "run")).alias("j"))
    return best.select(key, "j.*")


#: The answers of each task: (field, how it is read, its choices).
OUTPUTS = {
    "content": (("is_relevant", "bool", ()), ("ai_summary", "str", ()), ("platform_stance", "choice", PLATFORM_STANCES), ("stance_confidence", "float", ()), ("risk_level", "choice", RISKS), ("risk_reasoning", "str", ())),
    "question": (("is_relevant", "bool", ()),),
    "event": (("is_relevant", "bool", ()), ("stance", "choice", EVENT_STANCES), ("confidence", "float", ())),
}


def typed(raw: Column, task: str) -> Column:
    """struct of a task's answers and ``error``: of a reply that is no object or has a wrong field nothing is taken, and the error names the first such field. Fields that the task doesn't know are passed over."""

    def read(r: Column) -> Column:
        values, errors = [], [F.when(r.isNull(), "no object")]
        for name, how, choices in OUTPUTS[task]:
            if how in ("bool", "choice"):
                value = replies.require_bool(r, name) if how == "bool" else replies.require_choice(r, name, choices)
                errors.append(F.when(value.isNull(), f"{name}: missing or wrong"))
            else:
                both = replies.optional_str(r, name) if how == "str" else replies.optional_float(r, name)
                value = both["value"]
                errors.append(F.when(both["error"].isNotNull(), F.concat(F.lit(f"{name}: "), both["error"])))
            values.append((name, value))
        error = F.coalesce(*errors)
        return F.named_struct(*(x for n, c in values for x in (F.lit(n), F.when(error.isNull(), c))), F.lit("error"), error)

    return once(replies.parse_reply(raw), read)


class Status(Exception):
    """A reply other than success; ``code`` is its status."""

    def __init__(self, code: int, text: str = "") -> None:
        super().__init__(f"status {code}: {text[:200]}")
        self.code = code


def patient(judge: Callable[[str], str], attempts: int = 3, base: float = 1.5, wait: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """judge, asked up to ``attempts`` times, with ``base ** n`` seconds after the n-th.

    It is asked again where waiting may help: status 429, 500 and above, or no connection
    (OSError, time-outs included). Other statuses and errors are raised at once, the last
    failure after the last attempt.
    """

    def ask(text: str) -> str:
        for n in range(1, attempts + 1):
            try:
                return judge(text)
            except (Status, OSError) as e:
                lasting = isinstance(e, Status) and e.code != 429 and e.code < 500
                if lasting or n == attempts:
                    raise
                wait(base**n)
        raise ValueError("no attempts")

    return ask


def batch_report(judged: DataFrame) -> DataFrame:
    return judged.agg(F.count_if("ok").alias("done"), F.count_if(~F.col("ok")).alias("failed"), F.count("*").alias("total"))

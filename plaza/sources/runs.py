"""Runs of a collection: manifests, shards, keyword lists, migration files and settings, through Spark's file systems."""

from __future__ import annotations

import gzip
import json
import re
import time
from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ddl import columns
from .jsonl import SAMPLES, append_log

STATE = columns("run_id string, mode string, status string, cursor map<string,string>, note string")
#: A number of four digits and a name in small letters; with capitals the order would depend on the file system.
MIGRATION = re.compile(r"[0-9]{4}(_[0-9a-z]*)+[.]sql")


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file(spark, path)
    return fs.exists(p)


def _read(spark: SparkSession, path: str) -> str | None:
    p, fs = _file(spark, path)
    return spark.read.text(path, wholetext=True).first()[0] if fs.exists(p) else None


def _write(spark: SparkSession, path: str, content: str | bytes) -> None:
    """Writes beside the file and moves it into place, so that no reader sees a part."""
    p, fs = _file(spark, path)
    fresh, _ = _file(spark, f"{path}.next")
    out = fs.create(fresh, True)
    out.write(bytearray(content.encode() if isinstance(content, str) else content))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()) if p.toUri().getScheme() else spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(fresh, p, options)


def save_state(spark: SparkSession, root: str, state: Mapping) -> None:
    """Replaces a run's manifest as a whole."""
    _write(spark, f"{root}/{state['run_id']}/task.json", json.dumps({f.name: state.get(f.name) for f in STATE}, ensure_ascii=False))


def resume_run(spark: SparkSession, root: str, run_id: str) -> dict | None:
    """A run's state; null if the manifest is missing or broken."""
    text = _read(spark, f"{root}/{run_id}/task.json")
    try:
        got = json.loads(text) if text else None
    except ValueError:
        return None
    return got if isinstance(got, dict) else None


def advance(spark: SparkSession, root: str, run_id: str, **cursor: str) -> dict:
    """Merges values into a run's cursor and saves it."""
    state = resume_run(spark, root, run_id) or {"run_id": run_id}
    state["cursor"] = {**(state.get("cursor") or {}), **{k: str(v) for k, v in cursor.items()}}
    save_state(spark, root, state)
    return state


def list_runs(spark: SparkSession, root: str) -> DataFrame:
    """The states of all runs, newest name first; broken manifests are left out."""
    p, fs = _file(spark, root)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/task.json")) if fs.exists(p) else []
    if not found:
        return spark.createDataFrame([], STATE)
    text = spark.read.text([f.getPath().toString() for f in found], wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder"), "value")
    rows = text.where(F.try_parse_json("value").isNotNull()).select("folder", F.from_json("value", STATE).alias("s")).where("s.run_id is not null")
    return rows.orderBy(F.desc("folder")).select("s.*")


def load_keywords(spark: SparkSession, path: str) -> DataFrame:
    """(keyword): the non-empty keywords of a JSON-lines file in order; a missing file has none."""
    p, fs = _file(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], "keyword string")
    words = spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), F.trim(F.get_json_object("value", "$.keyword")).alias("keyword")).where("keyword <> ''")
    return words.orderBy("at").select("keyword")


def save_shard(spark: SparkSession, run: str, who: str, items: list[str]) -> None:
    _write(spark, f"{run}/shards/{who}.json", json.dumps({"who": who, "items": items}, ensure_ascii=False))


def load_shard(spark: SparkSession, run: str, who: str) -> list[str]:
    """A person's share of a run; none if the file is missing or broken."""
    try:
        got = json.loads(_read(spark, f"{run}/shards/{who}.json") or "{}")
        return [str(x) for x in got.get("items") or []]
    except (ValueError, AttributeError):
        return []


def packed_text(text: str) -> bytes:
    """gzip without a time or a name, so that equal texts are equal bytes."""
    return gzip.compress(text.encode(), mtime=0)


def save_snapshot(spark: SparkSession, path: str, text: str) -> str | None:
    """Writes a text as ``<path>.gz`` and returns that path; null if it can't be written, which fails no batch."""
    try:
        _write(spark, f"{path}.gz", packed_text(text))
    except Exception:  # noqa: BLE001  the record is kept with a null path
        return None
    return f"{path}.gz"


def one_by_one[X, Y](items: Iterable[X], run: Callable[[X], Y], pause: float = 0) -> tuple[list[Y], BaseException | None]:
    """What run gave for the items in order, up to the first that failed, and its error: the caller reports first and raises then."""
    done: list[Y] = []
    try:
        for item in items:
            done.append(run(item))
            time.sleep(pause)
    except BaseException as e:  # noqa: BLE001  an interrupt must not lose what is done
        return done, e
    return done, None


def collect_keywords(spark: SparkSession, root: str, run_id: str, keywords: Iterable[str], collect: Callable[[str], int], pause: float = 0) -> int:
    """Collects keywords one by one and returns the rows found.

    Blank keywords are skipped, none at all is an error. A sample is logged and the cursor moved
    after each; the run's status is running, then done, or failed, with the error raised.
    """
    wanted = [k.strip() for k in keywords if k.strip()]
    if not wanted:
        raise ValueError("no keywords")
    save_state(spark, root, {**(resume_run(spark, root, run_id) or {"run_id": run_id}), "status": "running"})

    def one(numbered: tuple[int, str]) -> int:
        i, keyword = numbered
        n = collect(keyword)
        at = datetime.now(UTC).isoformat(timespec="seconds")
        append_log(spark.createDataFrame([(at, keyword, "search", n, None, None)], SAMPLES), f"{root}/{run_id}", "runs")
        advance(spark, root, run_id, keyword_index=str(i))
        return n

    found, error = one_by_one(enumerate(wanted, 1), one, pause)
    save_state(spark, root, {**(resume_run(spark, root, run_id) or {}), "run_id": run_id, "status": "failed" if error else "done"})
    if error:
        raise error
    return sum(found)


def run_status(spark: SparkSession, root: str, keywords: str, latest: int = 5) -> DataFrame:
    """(run_id, mode, status, n_keywords) of the latest runs."""
    n = load_keywords(spark, keywords).agg(F.count("*").alias("n_keywords"))  # one row
    return list_runs(spark, root).limit(latest).select("run_id", "mode", "status").crossJoin(F.broadcast(n))


def discover_migrations(spark: SparkSession, folder: str) -> DataFrame:
    """(version, name, sql, checksum) of the SQL files of a folder in order; a name that isn't ``NNNN_name.sql``, or a number that comes twice, raises."""
    from ..functions.text import file_checksum

    p, fs = _file(spark, folder)
    names = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().endswith(".sql"))
    if bad := [n for n in names if not MIGRATION.fullmatch(n) or n[5:] == ".sql"]:
        raise ValueError(f"no migration names: {bad}")
    if len({n[:4] for n in names}) < len(names):
        raise ValueError("a number comes twice")
    if not names:
        return spark.createDataFrame([], "version int, name string, sql string, checksum string")
    text = spark.read.text([f"{folder}/{n}" for n in names], wholetext=True)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return text.select(F.substring(name, 1, 4).cast("int").alias("version"), name.alias("name"), F.col("value").alias("sql"), file_checksum(F.col("value")).alias("checksum")).orderBy("version")


def settings(text: str, environment: Mapping[str, str]) -> dict[str, str]:
    """The values of a settings file, NAME=value a line; the environment wins, a # in a value is part of it."""
    out = {}
    for line in text.splitlines():
        name, sign, value = line.strip().partition("=")
        if sign and not name.startswith("#"):
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out | {k: v for k, v in environment.items() if k in out}


def read_workdir(spark: SparkSession, folder: str, names: tuple[str, ...]) -> dict[str, str]:
    """One text file a module; a missing file is an empty module."""
    return {n: _read(spark, f"{folder}/{n}.txt") or "" for n in names}


def write_workdir(spark: SparkSession, folder: str, modules: Mapping[str, str]) -> None:
    for n, text in modules.items():
        _write(spark, f"{folder}/{n}.txt", text)


def write_report(spark: SparkSession, path: str, title: str, counts: DataFrame) -> None:
    """A Markdown table of a small aggregate."""
    rows = counts.limit(1000).collect()  # a report is read by a person
    lines = [f"# {title}", "", "| " + " | ".join(counts.columns) + " |", "|" + " --- |" * len(counts.columns)]
    _write(spark, path, "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n")

"""Append-only JSON-lines logs as tables with file and line order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ddl import columns
from ..operators.sequence import numbered

URLS = columns("url string, content_type string, question_id string, keyword string, title string, excerpt string, voteup_count int, comment_count int")
CONTENTS = columns("url string, content_type string, platform_id string, parent_id string, question_id string, title string, author_name string, author_url string, text string, text_length int, content_text string, storage_path string, voteup_count int, comment_count int, published_at string, published_text string, raw_content_hash string, snapshot_path string, keyword string, collected_at string")
SAMPLES = columns("at string, keyword string, kind string, result_count int, page int, elapsed_ms int")
LOGS = {"urls": URLS, "contents": CONTENTS, "answers": CONTENTS, "runs": SAMPLES}


#: Logs whose rows may have no other keys than their columns, and the keys that they must have.
STRICT = {"urls": ("url",), "runs": ("at", "keyword", "kind", "result_count")}


def scan_lines(spark: SparkSession, run: str, name: str) -> DataFrame:
    """(line_no, row, fate) of a log's lines that aren't blank, in order. fate: kept, broken (no JSON object), unexpected or incomplete (keys of a strict log).

    The log is a file, or the folder that ``append_log`` writes. An unknown name raises, a missing log is empty.
    """
    schema = LOGS[name]
    path = f"{run.rstrip('/')}/{name}.jsonl"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    text = spark.read.text(path) if there else spark.createDataFrame([], "value string").withColumn("_metadata", F.struct(F.lit("").alias("file_path"), F.lit(0).cast("long").alias("file_block_start")))
    place = F.struct(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block_start"), F.monotonically_increasing_id().alias("id"))
    lines = text.select(place.alias("line_no"), F.trim("value").alias("line")).where("line <> ''")
    keys = F.json_object_keys("line")
    names = F.array(*(F.lit(f.name) for f in schema))
    fate = F.when(F.try_parse_json("line").isNull() | keys.isNull(), "broken")
    if name in STRICT:
        fate = fate.when(F.size(F.array_except(keys, names)) > 0, "unexpected").when(F.size(F.array_except(F.array(*map(F.lit, STRICT[name])), keys)) > 0, "incomplete")
    return lines.select("line_no", F.from_json("line", schema).alias("row"), fate.otherwise("kept").alias("fate"))


def scan_ordered(spark: SparkSession, run: str, name: str) -> DataFrame:
    """``scan_lines`` with ``ord``: the line's number from 0 on among all lines of the log that aren't blank, in the order of its files and of their lines, however Spark splits them."""
    placed = scan_lines(spark, run, name).select(F.col("line_no.file_path").alias("__file"), F.col("line_no.file_block_start").alias("__at"), F.col("line_no.id").alias("__id"), "row", "fate")
    return numbered(placed, ["__file", "__at", "__id"], "ord").select("ord", "row", "fate")


def scan_log(spark: SparkSession, run: str, name: str) -> DataFrame:
    """The rows of a run's log that are kept; see ``scan_lines``, which tells what became of the others."""
    return scan_lines(spark, run, name).where("fate = 'kept'").select("row.*")


def dropped(spark: SparkSession, run: str, name: str) -> DataFrame:
    """(fate, n): lines of a log by what became of them."""
    return scan_lines(spark, run, name).groupBy("fate").agg(F.count("*").alias("n"))


def scan_bodies(spark: SparkSession, run: str) -> DataFrame:
    """Bodies of a run, answers before contents, in the order (file_rank, line_no)."""
    parts = [scan_lines(spark, run, name).where("fate = 'kept'").select(F.lit(i).alias("file_rank"), "line_no", "row.*") for i, name in enumerate(("answers", "contents"))]
    return parts[0].unionByName(parts[1])


def append_log(rows: DataFrame, run: str, name: str) -> None:
    """Appends to a log's folder, which ``scan_log`` and stream readers follow. Nulls are written, so that rows keep their keys."""
    LOGS[name]
    rows.write.mode("append").option("ignoreNullFields", "false").json(f"{run.rstrip('/')}/{name}.jsonl")

"""Tables in the folder that driver and executors share, where a result must be computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset a local session gets a folder of its own, a cluster an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="plaza-shared-")  # one machine: everyone sees it
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows, written as a table and read again; the table stays for the folder's own clean-up."""
    path = f"{shared_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

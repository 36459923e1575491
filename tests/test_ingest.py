"""Batches of records into the tables: authors, questions, parents, the gate, and counters in the same pass."""

import pytest
from plaza.ddl import columns
from plaza.operators import ingest, lookups, store
from plaza.schema import TABLES
from pyspark.sql import functions as F

BATCH = "ord int, url string, content_type string, platform_id string, parent_platform_id string, author_platform_id string, author_name string, author_url string, question_platform_id string, snapshot_path string, title string"


@pytest.fixture
def tables(spark):
    return {
        "contents": spark.createDataFrame([("old", "u0")], "content_id string, url string").select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in columns("author_id long, question_id long, parent_id string, title string").fields)),
        "authors": spark.createDataFrame([(7, "ann", "Ann", "p/ann")], "author_id long, platform_user_id string, nickname string, profile_url string"),
        "questions": spark.createDataFrame([(3, "q3", True), (4, "q4", False)], "question_id long, platform_qid string, is_relevant boolean"),
    }


def batch(spark):
    rows = [
        (1, "u1", "answer", "1", None, "bob", "Bob", None, "q3", "s", "t1"), (2, "u1", "answer", "1", None, "bob", "Bobby", "p/bob", "q3", None, "again"), (3, "u2", "comment", "c", "1", "ann", None, None, "q9", "s", "t2"),
        (4, "u3", "comment", "d", "99", None, None, None, None, None, "t3"), (5, "u0", "answer", "5", None, "cat", "Cat", None, "q4", "s", "t4"),
    ]
    return spark.createDataFrame(rows, BATCH)


def test_records_become_rows(spark, tables):
    done = ingest.ingest_contents(batch(spark), **tables)
    assert done.report() == {"inserted": 3, "duplicates": 2, "dangling_parents": 1, "no_snapshot": 2, "unresolved_authors": 1, "unresolved_questions": 2}
    assert sorted(map(tuple, done.authors.collect())) == [(7, "ann", None, None), (8, "bob", "Bobby", "p/bob"), (9, "cat", "Cat", None)]
    cid = {u: spark.range(1).select(store.content_id(F.lit(u))).first()[0] for u in ("u1", "u2", "u3")}
    got = {r.url: (r.content_id, r.author_id, r.question_id, r.parent_id, r.title) for r in done.contents.collect()}
    assert got == {"u0": ("old", None, None, None, None), "u1": (cid["u1"], 8, 3, None, "t1"), "u2": (cid["u2"], 7, None, cid["u1"], "t2"), "u3": (cid["u3"], None, None, None, "t3")}
    assert {r.url: r.content_id for r in done.content_ids().collect()} == cid
    # the same batch again inserts nothing and names the same authors
    again = ingest.ingest_contents(batch(spark), done.contents, done.authors, tables["questions"])
    assert again.report() == {"inserted": 0, "duplicates": 5, "dangling_parents": 2, "no_snapshot": 2, "unresolved_authors": 1, "unresolved_questions": 2}
    assert sorted(map(tuple, again.authors.collect())) == sorted(map(tuple, done.authors.collect())) and again.content_ids().count() == 0


def test_the_gate_and_the_analysis_belong_to_the_same_batch(spark, tables):
    judged = [("u1", False, "不相关"), ("u2", True, "有利"), ("u3", False, None)]
    judgments = spark.createDataFrame(judged, "url string, is_relevant boolean, platform_stance string").withColumn("risk_level", F.lit("低风险"))
    analysis = spark.createDataFrame([], columns("content_id string, platform_stance string, risk_level string"))
    done = ingest.ingest_contents(batch(spark), **tables, judgments=judgments, relevant=tables["questions"].where("is_relevant"), analysis=analysis)
    report = done.report()
    assert report == {"inserted": 2, "duplicates": 1, "dangling_parents": 0, "no_snapshot": 1, "unresolved_authors": 0, "unresolved_questions": 1, "kept_by_parent": 2, "dropped_irrelevant": 1, "dropped_unknown_parent": 0, "unjudged": 1, "rejected_question": 0, "stance_conflict": 0}
    grouped = {r.disposition: r.n for r in done.batch.groupBy("disposition").agg(F.count("*").alias("n")).collect()}
    assert grouped == {"kept": 1, "kept_by_parent": 2, "dropped_irrelevant": 1, "unjudged": 1}
    new = {r.url: r.content_id for r in done.content_ids().collect()}
    assert set(new) == {"u1", "u2"} and {r.content_id: (r.platform_stance, r.risk_level) for r in done.analysis.collect()} == {new["u1"]: ("不相关", "低风险"), new["u2"]: ("有利", "低风险")}


def test_counters_come_from_the_one_pass(spark, tables):
    counted = spark.sparkContext.accumulator(0)
    rows = batch(spark)
    seen = rows.select("*", F.udf(lambda x: (counted.add(1), x)[1], "int")("ord").alias("o")).drop("ord").withColumnRenamed("o", "ord")
    done = ingest.ingest_contents(seen.select(rows.columns), **tables)
    once = counted.value
    assert done.report()["inserted"] == 3 and done.contents.count() == 4 and done.content_ids().count() == 3
    assert counted.value == once  # neither the report nor the tables computed the batch again


def test_an_empty_batch(spark, tables):
    done = ingest.ingest_contents(batch(spark).limit(0), **tables)
    assert set(done.report().values()) == {0} and done.contents.count() == 1 and done.authors.count() == 1
    assert TABLES["fact_content"].unique == (("url",),)


def test_a_question_s_message(spark):
    rows = spark.createDataFrame([(" t ", " d "), ("t", " "), ("t", None), (" ", "d"), (None, "d")], "t string, d string")
    got = [r[0] for r in rows.select(ingest.question_message(F.col("t"), F.col("d"), ("T:", "D:"), "none")).collect()]
    assert got == ["T:t\nD:d", "T:t\nD:none", "T:t\nD:none", None, None]


def test_look_ups_are_one_join(spark, tables):
    asked = spark.createDataFrame([("q3", 1), ("q3", 2), ("q8", 3), (None, 4)], "platform_qid string, found int")
    got = lookups.look_up(asked.withColumnRenamed("found", "n"), "question_id_for", tables["questions"]).orderBy("n").collect()
    assert [(r.n, r.found, r.answer and r.answer.question_id) for r in got] == [(1, True, 3), (2, True, 3), (3, False, None), (4, False, None)]
    rows = spark.createDataFrame([("c", "0.8")], "content_id string, stance_confidence string").withColumn("stance_confidence", F.col("stance_confidence").cast("decimal(3,2)"))
    record = lookups.as_record(rows, "fact_analysis")
    assert record.schema == TABLES["fact_analysis"].columns and record.first().stance_confidence == 0.8 and record.first().risk_level is None
    with pytest.raises(ValueError, match="has no"):
        lookups.as_record(rows.withColumn("more", F.lit(1)), "fact_analysis")

"""A log of commands against a loop that applies them one after another."""

import random

import pytest
from plaza.ddl import columns
from plaza.operators import commands
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = columns("k string, j int, a string, b int, done boolean, seen long")
KEYS = ("k", "j")


def one_by_one(current, log, keep, claimed_null, forced):
    state, won = {r[:2]: dict(zip(SCHEMA.names, r, strict=True)) for r in current}, []
    for ord_, op, k, j, a, b in sorted(log):
        key, given = (k, j), {"a": a, "b": b, "done": None, "seen": None}
        there = key in state
        if op in ("replace", "upsert", "patch"):
            given |= forced
        if not there:
            if op in commands.CREATING:
                state[key] = dict(zip(KEYS, key, strict=True)) | {c: None if op == "claim" and c in claimed_null else v for c, v in given.items()}
                won.append((ord_, k, j, op))
            continue
        row = state[key]
        if op == "replace":
            row |= {c: v for c, v in given.items() if c not in keep or c in forced}
        elif op in ("upsert", "patch"):
            row |= {c: v for c, v in given.items() if v is not None}
        elif op == "mark" and not row["done"]:
            row["done"] = True
            won.append((ord_, k, j, op))
        elif op == "bump":
            row["seen"] = (row["seen"] or 0) + 1
    return sorted(repr(tuple(r[c] for c in SCHEMA.names)) for r in state.values()), sorted(won)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(("keep", "forced"), [(("done", "seen"), {}), (("done", "seen", "b"), {"a": "human"})])
def test_any_log(spark, seed, keep, forced):
    r = random.Random(seed)
    current = [("p", 1, "x", None, False, 3), ("p", 2, None, 4, None, None), (" q", 1, "y", 5, True, 0)]
    log = [(i, r.choice(commands.KINDS), r.choice(["p", "p", "q", " q", "r"]), r.randint(1, 3), r.choice([None, "s", "t"]), r.choice([None, 7, 8])) for i in range(r.choice([5, 40, 200]))]
    shuffled = r.sample(log, len(log))
    now = spark.createDataFrame(current, SCHEMA)
    after, won = commands.apply_log(now, spark.createDataFrame(shuffled, "ord long, op string, k string, j int, a string, b int"), list(KEYS), keep, "done", "seen", ("b",), {c: F.lit(v) for c, v in forced.items()})
    assert after.columns == SCHEMA.names and after.schema["seen"].dataType == T.LongType()
    assert (sorted(repr(tuple(x)) for x in after.collect()), sorted(map(tuple, won.collect()))) == one_by_one(current, log, keep, ("b",), forced)


def test_logs_of_nothing_and_of_errors(spark):
    now = spark.createDataFrame([("p", 1, "x", None, False, 3)], SCHEMA)
    log = spark.createDataFrame([(0, "insert", "p", 1)], "ord int, op string, k string, j int")
    after, won = commands.apply_log(now, log.limit(0), list(KEYS), flag="done", counter="seen")
    assert after.collect() == now.collect() and won.count() == 0
    after, won = commands.apply_log(now.limit(0), log, list(KEYS))
    assert [tuple(r) for r in after.collect()] == [("p", 1, None, None, None, None)] and [tuple(r) for r in won.collect()] == [(0, "p", 1, "insert")]
    for bad in ((0, "delete", "p", 1), (0, None, "p", 1), (0, "insert", None, 1)):
        with pytest.raises(Exception, match="no command: ord 0"):
            commands.apply_log(now, spark.createDataFrame([bad], log.schema), list(KEYS))[0].collect()


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    log = spark.range(20_000).select(F.col("id").alias("ord"), F.lit("patch").alias("op"), F.lit("p").alias("k"), F.lit(1).alias("j"), F.col("id").cast("string").alias("a"))
    after, _ = commands.apply_log(spark.createDataFrame([("p", 1, "x", None, False, 3)], SCHEMA), log, list(KEYS))
    assert after.first().a == "19999"
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "partial_min_by" in plan and "Window" not in plan

"""The maintained view against a replay of the batches, row by row."""

import datetime
import math
import zlib
from collections import defaultdict

import pytest
from plaza.llm import queries
from plaza.llm import view_maintenance as vm

GROUP, IDS = ["region", "part"], ["client_id", "item_id"]
TABLES = ("clients", "sales", "sale_lines", "vendors", "nation")


def alive(name, batch):
    h = zlib.crc32(name.encode())
    a, d = h % 7, h // 7 % 7
    return a <= batch < d if a < d else True


def replay(clients, sales, lines, vendors, nations):
    """Each batch's view from the rows that are there after it."""
    region = {x["n_nationkey"]: x["n_regionkey"] for x in nations}
    out = {}
    for batch in range(7):
        cs, ss = defaultdict(list), defaultdict(list)
        for c in clients:
            if c["client_id"] is not None and alive(f"c{c['client_id']}", batch) and region.get(c["nation_id"]) is not None:
                cs[c["client_id"]].append(region[c["nation_id"]])
        for s in sales:
            if s["sale_id"] is not None and s["sold_at"] is not None and alive(f"s{s['sale_id']}", batch):
                ss[s["sale_id"]].append(s)
        groups = defaultdict(list)
        for i in lines:
            if i["amount"] is None or i["line_no"] is not None and not alive(f"l{i['sale_id']}:{i['line_no']}", batch):
                continue
            revenue = None if i["discount"] is None else math.floor(100 * i["amount"] + 0.5) * (100 - math.floor(100 * i["discount"] + 0.5))
            for s in ss.get(i["sale_id"], []):
                for r in cs.get(s["client_id"], []):
                    for v in vendors:
                        if v["vendor_id"] == i["vendor_id"] and region.get(v["nation_id"]) == r:
                            groups[r, (s["sold_at"] - datetime.datetime(1970, 1, 1)).days].append((revenue, s["client_id"], i["item_id"]))
        for g, rows in groups.items():
            known = [r for r, *_ in rows if r is not None]
            out[batch, *g] = (len(rows), sum(known) if known else None, min(known, default=None), len({c for _, c, _ in rows}), len({i for *_, i in rows if i is not None}))
    return out


def test_query_equals_a_replay(spark, small, table):
    got = {tuple(r)[:3]: tuple(r)[3:] for r in queries.op12_view_maintenance(spark, small).collect()}
    want = replay(*(table(small, t) for t in TABLES))
    assert got == want and len({k[0] for k in got}) == 7


def test_cubes_of_parts_merge_to_the_cube_of_all(spark, small):
    rows = vm.shop_rows(*(spark.read.parquet(f"{small}/{t}.parquet") for t in TABLES))
    whole = vm.lifetime_cube(rows, GROUP, "revenue", IDS)
    part = "pmod(hash(revenue, item_id), 3)"
    first, second = (vm.lifetime_cube(rows.where(w), GROUP, "revenue", IDS) for w in (f"{part} = 0", f"{part} <> 0"))
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    merged = vm.merge_cubes(first, second, GROUP)
    assert same(merged, whole)
    assert same(vm.view_after_batches(merged, GROUP, IDS), vm.view_after_batches(whole, GROUP, IDS))
    assert same(vm.merge_cubes(whole, whole.limit(0), GROUP), whole)


@pytest.mark.parametrize("batches", [1, 2, 7, 10])
def test_classes_have_numbers_of_their_own(spark, batches):
    classes = vm._classes(batches)
    got = spark.createDataFrame(classes, "start int, end int").select(vm._number(vm.F.col("start"), vm.F.col("end"), batches).alias("c")).collect()
    assert [r.c for r in got] == list(range(batches * (batches + 1) // 2))
    rows = spark.createDataFrame([("g", a, d, 1) for a, d in classes], "g string, start int, end int, v long")
    view = vm.view_after_batches(vm.lifetime_cube(rows, ["g"], "v", [], batches), ["g"], [], batches)
    assert {r.batch: r.n for r in view.collect()} == {b: sum(a <= b < d for a, d in classes) for b in range(batches)}


def frame(spark, kind, rows):
    return spark.createDataFrame(rows, kind), [dict(zip([c.split()[0] for c in kind.split(", ")], r, strict=True)) for r in rows]


def test_odd_rows(spark):
    """Nulls in each column, repeated rows of every table, amounts that aren't finite, clashing columns."""
    at = datetime.datetime(2024, 1, 5, 23, 59)
    tables = [
        frame(spark, "client_id long, nation_id int, part string, revenue string", [(1, 0, "x", "x"), (1, 0, "x", "x"), (2, None, None, None), (None, 0, "x", "x"), (3, 1, "x", "x"), (4, 9, "x", "x")]),
        frame(spark, "sale_id long, client_id long, sold_at timestamp_ntz, region string", [(10, 1, at, "x"), (10, 1, at, "x"), (11, 2, at, "x"), (12, 3, None, "x"), (13, None, at, None), (None, 1, at, "x"), (14, 3, at, "x"), (15, 4, at, "x"), (16, 3, at, "x")]),
        frame(spark, "sale_id long, line_no int, item_id long, vendor_id long, amount double, discount double, start string",
              [(10, 1, 5, 7, 10.0, 0.1, "x")] * 3 + [(10, 2, None, 7, 1.005, 0.0, "x"), (10, None, 6, 7, 3.0, 0.0, "x"), (10, 3, 6, 7, None, 0.0, "x"), (10, 4, 6, 7, 2.0, None, "x"), (14, 1, 6, 8, 9.0, 0.0, "x"), (14, 1, 6, 7, 9.0, 0.0, "x"), (None, 1, 6, 7, 9.0, 0.0, "x"), (14, 2, 6, None, 9.0, 0.0, "x"), (16, 1, 8, 8, 4.0, None, "x")]),
        frame(spark, "vendor_id long, nation_id int, item_id string", [(7, 0, "x"), (7, 2, "x"), (None, 0, "x"), (8, 1, "x"), (9, None, "x")]),
        frame(spark, "n_nationkey int, n_regionkey int, end string", [(0, 0, "x"), (1, 3, "x"), (2, 0, "x"), (9, None, "x"), (None, 0, "x")]),
    ]
    view = lambda frames: vm.view_after_batches(vm.lifetime_cube(vm.shop_rows(*frames), GROUP, "revenue", IDS), GROUP, IDS)
    frames = [f for f, _ in tables]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in view(frames).collect()} == replay(*(rows for _, rows in tables))
    broken = frames[2].unionByName(frames[2].limit(1).selectExpr("sale_id", "99 line_no", "item_id", "vendor_id", "double('nan') amount", "discount", "start")).unionByName(frames[2].limit(1).selectExpr("sale_id", "98 line_no", "item_id", "vendor_id", "double('inf') amount", "discount", "start"))
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert same(view([*frames[:2], broken, *frames[3:]]), view(frames))
    for k in range(5):
        assert view([f.limit(0) if i == k else f for i, f in enumerate(frames)]).count() == 0
    many = spark.range(vm.MAX_NATIONS + 1).selectExpr("cast(id + 100 as int) n_nationkey", "1 n_regionkey", "'x' `end`")
    assert same(view([*frames[:4], frames[4].unionByName(many)]), view(frames))
    with pytest.raises(ValueError, match="batches"):
        vm.lifetime_cube(frames[0], GROUP, "revenue", IDS, vm.MAX_BATCHES + 1)

"""Functions, stores, logs and streams on small rows."""

import json
import os
import random
import re
import time

import pytest
from plaza.functions import html, similarity, text, urls
from plaza.operators import judge, prescreen, search, sequence, store
from plaza.sources import jsonl
from plaza.streaming import ingest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("//www.zhihu.com/question/1/answer/2?x=1#y", ("https://www.zhihu.com/question/1/answer/2", "answer", "2", "1")), ("/question/5/", ("https://www.zhihu.com/question/5", "question", "5", "5")),
        ("www.zhihu.com/p/9", ("https://zhuanlan.zhihu.com/p/9", "article", "9", None)), (" https://M.zhihu.com/pin/7 ", ("https://www.zhihu.com/pin/7", "thought", "7", None)),
        ("https://www.zhihu.com/people/a", None), ("https://evil.com/p/9", None), ("", None), (None, None), ("https://www.zhihu.com/question/1/answer/2/x", None),
    ],
)
def test_normalize_url(spark, raw, want):
    got = one(spark, urls.normalize_url, raw)
    assert (tuple(got) if got else None) == want
    if got:
        assert tuple(one(spark, urls.normalize_url, got.url)) == want


def test_profile_and_search_urls(spark):
    assert one(spark, urls.profile_user_id, "/people/gq-1/") == "gq-1"
    assert one(spark, urls.profile_user_id, "/people/gq/followers") is None
    assert one(spark, lambda c: urls.search_url("https://x/s?q=", c), "a b/中~*") == "https://x/s?q=a%20b/%E4%B8%AD~%2A"


def said_counts():
    """(text, count): each unit with numbers, blanks and surroundings of all sorts."""
    for unit, times in {"": 1, "万": 10_000, "千": 1_000, "k": 1_000, "K": 1_000}.items():
        for number, value in {"7": 7, "12": 12, "8,765": 8765, "0": 0, "2.5": 2.5, "0.3": 0.3}.items():
            for blank in ("", " ", "  ") if unit else ("",):
                for before, after in (("", ""), ("x ", " 次"), ("共", "。"), ("", " 19")):
                    if unit or not after.strip()[:1].isdigit():
                        yield f"{before}{number}{blank}{unit}{after}", int(value * times)


def test_parse_count(spark):
    rows = [*said_counts(), ("", 0), (None, 0), ("无", 0), (".", 0), ("x.5", 5), ("1..5", 1), ("3 4", 34), ("9.", 9)]
    got = spark.createDataFrame(rows, "said string, n long").withColumn("got", text.parse_count(F.col("said"))).collect()
    assert not [(r.said, r.n, r.got) for r in got if r.n != r.got]


@pytest.mark.parametrize("blank", ["", " ", " \t ", "\u3000"])
@pytest.mark.parametrize(("number", "value"), [("0", 0), ("5", 5), ("6,543", 6543), ("1,000,000", 1_000_000)])
def test_counts_in_phrases(spark, number, value, blank):
    comments, answers, folded = (f"{number}{blank}{x}" for x in ("条评论", "个回答", "个回答被折叠"))
    assert one(spark, text.comment_total, f"\ufeff {comments}\u200b ") == value
    assert one(spark, text.comment_total, f"x {comments}") is one(spark, text.comment_total, f"{comments} x") is one(spark, text.comment_total, f"x{number}") is None
    assert one(spark, text.question_total, f"1 x {answers}, 99 个回答") == value and one(spark, text.question_total, number) is None
    assert one(spark, text.collapsed_count, f"2 个回答 {folded} x") == value and one(spark, text.collapsed_count, answers) == 0
    assert one(spark, text.count_in_text, f"赞 8 {comments} 02-03") == value and one(spark, text.count_in_text, number) == 0


def test_counts_in_phrases_with_units(spark):
    for unit, times in text.UNITS.items():
        assert one(spark, text.count_in_text, f"条评论 4 3.5 {unit} 条评论 7 条评论") == int(3.5 * times)


def said_dates():
    """(text, moment): years, months and days with each separator, times and surroundings."""
    for y, m in (("-", "-"), ("/", "/"), ("年", "月"), ("-", "/")):
        for day in ("", "日"):
            for before, after in (("", ""), ("于 ", " 改"), ("3.", "，")):
                yield f"{before}2023{y}4{m}5{day}{after}", "2023-04-05 00:00:00"
                yield f"{before}2023{y}04{m}15{day}  7:08{after}", "2023-04-15 07:08:00"
                yield f"{before}2023{y}4{m}5{day}7:08{after}" if day else f"{before}2023{y}4{m}5 7:8{after}", "2023-04-05 00:00:00"


def test_parse_datetime(spark):
    none = ["02-28", "3 小时前", "2023-13-01", "2023-02-30", "2023-1", "2023:1-2", "23-1-2", "2023-111-2", "", None, "2023年1日2"]
    rows = [*said_dates(), *((x, None) for x in none), ("92023-1-234 5:06", "2023-01-23 00:00:00"), ("1-2 2023-1-2 25:00", None), ("2023-1-2 3:045", "2023-01-02 03:04:00")]
    got = spark.createDataFrame(rows, "said string, at string").withColumn("got", text.parse_datetime(F.col("said")).cast("string")).collect()
    assert not [(r.said, r.at, r.got) for r in got if r.at != r.got]


def grams_of(text):
    return [f"  {w} "[i : i + 3] for w in re.findall(r"[^\W_]+", text.lower()) for i in range(len(w) + 1)]


def plain_similarity(keyword, text):
    """All stretches one by one."""
    own, b = set(grams_of(keyword)), grams_of(text)
    best = 0.0
    for s in range(len(b)):
        for e in range(s + 1, len(b) + 1):
            common = len(own & set(b[s:e]))
            best = max(best, common / (len(own) + len(set(b[s:e])) - common) if own else 0.0)
    return round(best, 6)


def test_word_similarity(spark):
    r = random.Random(5)
    words = lambda n, letters: " ".join("".join(r.choices(letters, k=r.randint(1, 5))) for _ in range(n))
    rows = [("word", "two words"), ("word", ""), ("word", "word"), ("", "x"), (None, None), ("the nation", "the xx xx xx xx xx xx nation"), ("Größe 7", "größe-7, 日本"), ("ab", "ab " * 40)]
    rows += [(words(2, "ab"), words(12, "abc")) for _ in range(120)] + [(words(1, "abcdefgh"), words(10, "abcdefgh")) for _ in range(40)]
    got = spark.createDataFrame(rows, "k string, t string").select("k", "t", similarity.similarity(F.col("k"), F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == [pytest.approx(plain_similarity(k or "", t or "")) for k, t in rows]
    assert got[0].s == 0.8 and got[2].s == 1


def test_prescreen_meets_few_of_many_keywords(spark):
    r = random.Random(6)
    words = lambda n: " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(4, 9))) for _ in range(n))
    texts = [words(12) for _ in range(60)]
    keywords = [words(2) for _ in range(960)] + [" ".join(t.split()[3:5]) for t in texts[:40]]
    content = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)] + [(98, "unjudged " + texts[0], None), (99, None, None)], "content_id long, title string, content_text string")
    analysis = spark.createDataFrame([(i, None) for i in [*range(60), 99]], "content_id long, ai_summary string")
    kw = spark.createDataFrame([(k,) for k in [*keywords, keywords[0], None, " ?"]], "keyword string")
    fields = ["title", "content_text", "ai_summary"]
    want = {(i, k): s for i, t in enumerate(texts) for k in set(keywords) if len(set(grams_of(k)) & set(grams_of(t))) >= 0.6 * len(set(grams_of(k))) and (s := plain_similarity(k, t)) >= 0.6}
    got = prescreen.prescreen(content, analysis, kw, fields, threshold=0.6, limit=None)
    assert {(x.content_id, x.keyword): x.score for x in got.collect()} == pytest.approx(want) and len(want) >= 40
    top = prescreen.prescreen(content, analysis, kw, fields, threshold=0.6, limit=7).collect()
    assert [(x.score, x.content_id, x.keyword) for x in top] == [(s, i, k) for s, i, k in sorted(((s, i, k) for (i, k), s in want.items()), key=lambda x: (-x[0], *x[1:]))[:7]]
    # the join by postings of rare trigrams gives far fewer rows than contents x keywords
    rows = content.join(analysis, "content_id").select("content_id", similarity.trigram_set(F.col("title")).alias("g")).select("content_id", F.explode("g").alias("gram"))
    postings = prescreen.keyword_postings(kw, rows.groupBy("gram").agg(F.count("*").alias("n")), 0.6)
    assert rows.join(postings, "gram").select("content_id", "keyword").distinct().count() < 0.1 * 60 * 1000
    shuffled = prescreen.BROADCAST_ROWS
    try:
        prescreen.BROADCAST_ROWS = 10
        again = prescreen.prescreen(content, analysis, kw, fields, threshold=0.6, limit=None)
        assert "BroadcastExchange" not in again._jdf.queryExecution().sparkPlan().toString()
        assert {(x.content_id, x.keyword): x.score for x in again.collect()} == pytest.approx(want)
    finally:
        prescreen.BROADCAST_ROWS = shuffled
    assert prescreen.prescreen(content, analysis, kw.limit(0), fields).count() == prescreen.prescreen(content.limit(0), analysis, kw, fields).count() == 0


def test_visible_text():
    assert html.visible_text("<p>a &amp; b<script>x()</script></p><b> c </b>") == "a & b\nc"
    assert html.visible_text(None) == ""


def test_store_versions_and_changes(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}")
    schema = T.StructType.fromDDL("k long, a string, n long")
    assert s.read("t", schema).count() == 0
    first = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], schema)
    s.commit("t", first)
    changes = spark.createDataFrame([(0, 1, None, 5), (1, 1, "z", None), (2, 3, "w", 7)], "ord long, k long, a string, n long")
    after = store.patch(s.read("t", schema), changes, ["k"], "ord", ["a", "n"])
    s.commit("t", after)
    want = {(1, "z", 5), (2, "y", 1), (3, "w", 7)}
    assert {tuple(r) for r in s.read("t", schema).collect()} == want
    again = store.patch(s.read("t", schema), changes, ["k"], "ord", ["a", "n"])
    assert {tuple(r) for r in again.collect()} == want
    next_, new = store.insert_ignore(s.read("t", schema), changes.withColumn("k", F.col("k") + 2), ["k"], "ord")
    assert {r.k for r in new.collect()} == {5} and next_.count() == 4
    assert {tuple(r) for r in store.replace(first, changes, ["k"], "ord").collect()} == {(1, "z", None), (2, "y", 1), (3, "w", 7)}
    with_id = store.with_ids(spark.createDataFrame([(5, "q")], "ord long, a string"), first, "k", "ord")
    assert with_id.first().k == 3


def test_search_refuses_unknown_sorts(spark):
    with pytest.raises(ValueError):
        search.search(None, None, None, None, sort="title; drop table")
    with pytest.raises(ValueError):
        sequence.shard(spark.range(3), ["id"], 3, 3)


def test_logs_drop_broken_lines(spark, tmp_path):
    lines = [json.dumps({"url": "u1", "voteup_count": 3}), '{"url": "half', "[1]", "", json.dumps({"url": "u2", "extra": 1}), json.dumps({"title": "no address"}), json.dumps({"url": "u3"})]
    (tmp_path / "urls.jsonl").write_text("\n".join(lines))
    assert [r.url for r in jsonl.scan_log(spark, str(tmp_path), "urls").collect()] == ["u1", "u3"]
    assert {r.fate: r.n for r in jsonl.dropped(spark, str(tmp_path), "urls").collect()} == {"kept": 2, "broken": 2, "unexpected": 1, "incomplete": 1}
    assert jsonl.scan_log(spark, str(tmp_path), "runs").count() == 0
    with pytest.raises(KeyError):
        jsonl.scan_log(spark, str(tmp_path), "other")


def test_judge_failures_are_rows(spark):
    rows = spark.createDataFrame([(1, "good"), (2, " "), (3, "bad")], "id long, text string")
    out = {r.id: r for r in judge.judge_each(rows, "id", "text", lambda t: t.upper() if t == "good" else 1 / 0, 2).collect()}
    assert (out[1].reply, out[2].error, out[3].ok) == ("GOOD", "ValueError: blank text", False)
    assert tuple(judge.batch_report(judge.judge_each(rows, "id", "text", str.upper)).first()) == (2, 1, 3)


def test_stream_equals_batch(spark, tmp_path):
    log, sink = tmp_path / "log", f"file://{tmp_path}/sink"
    rows = spark.createDataFrame([(f"u{i % 7}", "answer", i) for i in range(20)], "url string, content_type string, voteup_count int")
    schema = rows.schema

    known = spark.createDataFrame([("u6",), ("u6",), (None,)], "url string")
    start = lambda k: ingest.ingest_new(ingest.follow_log(spark, str(log), schema), "url", k, sink, f"{tmp_path}/cp", ["voteup_count"])
    for part in (rows.where("voteup_count < 10"), rows.where("voteup_count >= 10"), spark.createDataFrame([(None, "answer", 1), ("u1", "answer", -5), ("u9", "answer", 3), ("u9", "answer", 2)], schema)):
        part.write.mode("append").json(str(log))
        start(known).awaitTermination()
    want = sorted([*((f"u{i}", i) for i in range(6)), ("u9", 2)])
    read = lambda: sorted((r.url, r.voteup_count) for r in spark.read.parquet(sink).collect())
    assert read() == want
    # a batch that is replayed counts once
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"))
    for f in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        f.unlink(missing_ok=True)
    start(known).awaitTermination()
    assert read() == want
    # what is known is read before the first batch only: a table that can't be read any more does no harm
    broken = known.where(F.raise_error(F.lit("read again")).isNull())
    spark.createDataFrame([("u10", "answer", 1), ("u2", "answer", 1)], schema).write.mode("append").json(str(log))
    start(broken).awaitTermination()
    assert read() == sorted([*want, ("u10", 1)])


def test_a_baseline_is_read_once_a_round(spark, tmp_path):
    table = f"file://{tmp_path}/t"
    add = lambda *ks: spark.createDataFrame([(k, "x") for k in ks], "k int, x string").write.mode("append").parquet(table)
    add(1, 1, 2)
    base = ingest.Baseline(lambda: spark.read.parquet(table), ["k"])
    rows = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    rows.write.json(str(tmp_path / "in"))
    known = lambda: sorted(r.k for r in base.known(rows, ["k"]).where("is_known").collect())

    def streamed(name):
        stream = spark.readStream.schema("k int").json(str(tmp_path / "in"))
        base.known(stream, ["k"]).writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.k for r in spark.table(name).where("is_known").collect())

    assert known() == streamed("round1") == [1, 2]
    add(3)  # the table grows meanwhile
    assert known() == streamed("round2") == [1, 2]
    base.renew()
    assert known() == streamed("round3") == [1, 2, 3]


def test_lines_have_true_ordinals(spark, tmp_path):
    run = f"file://{tmp_path}"
    folder = tmp_path / "runs.jsonl"
    folder.mkdir()
    n = 0
    for name in ("a.json", "b.json", "c.json"):
        lines = []
        for _ in range(500):
            lines += [json.dumps({"at": str(n), "keyword": "k" * (n % 40), "kind": "search", "result_count": n})] + [""] * (n % 3 == 0)
            n += 1
        (folder / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = jsonl.scan_ordered(spark, run, "runs").orderBy("ord").collect()
            assert [(r.ord, r.row.result_count, r.fate) for r in got] == [(i, i, "kept") for i in range(n)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_requests_overlap_and_a_killed_run_goes_on(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def slow(t):
        (log / f"{t}-{time.monotonic_ns()}").touch()
        time.sleep(0.4)
        return t.upper()

    rows = spark.createDataFrame([(i, f"t{i}") for i in range(16)], "id int, t string").coalesce(1)
    began = time.monotonic()
    assert sorted(r.reply for r in judge.judge_each(rows, "id", "t", slow).collect()) == sorted(f"T{i}" for i in range(16))
    assert time.monotonic() - began < 0.4 * 16 * 0.7  # eight at a time
    table = f"file://{tmp_path}/judged"

    def dies(t):
        if t == "t7":
            os._exit(1)
        return slow(t)

    with pytest.raises(Exception):  # noqa: B017, PT011
        judge.judge_into(rows, "id", "t", dies, table, waves=8)
    done = spark.read.parquet(table).count()
    for f in log.iterdir():
        f.unlink()
    fails = lambda t: 1 / 0 if t == "t3" else slow(t)
    got = {r.id: (r.ok, r.reply) for r in judge.judge_into(rows, "id", "t", fails, table, waves=8).collect()}
    t3_known = 3 not in {i for i, (ok, _) in got.items() if not ok}
    assert len(got) == 16 and len(list(log.iterdir())) == 16 - done - (not t3_known)
    again = {r.id: (r.ok, r.reply) for r in judge.judge_into(rows, "id", "t", str.upper, table, waves=8).collect()}
    assert again == {i: (True, f"T{i}") for i in range(16)}


def test_typed_answers_of_three_tasks(spark):
    whole = '{"is_relevant": true, "ai_summary": " s ", "platform_stance": "有利", "stance_confidence": 0.5, "risk_level": "低风险", "stance": "正向", "confidence": 1, "more": 2}'
    rows = [(whole,), (whole.replace("0.5", "1.5"),), (whole.replace("true", '"true"'),), ("no",), (whole.replace("正向", "x").replace('" s "', "3"),)]
    got = spark.createDataFrame(rows, "raw string").select(*(judge.typed(F.col("raw"), t).alias(t) for t in judge.OUTPUTS)).collect()
    assert tuple(got[0].content) == (True, "s", "有利", 0.5, "低风险", None, None) and tuple(got[0].question) == (True, None) and tuple(got[0].event) == (True, "正向", 1.0, None)
    assert [r.content.error for r in got] == [None, "stance_confidence: out_of_range", "is_relevant: missing or wrong", "no object", "ai_summary: wrong_type"]
    assert [r.question.error for r in got] == [None, None, "is_relevant: missing or wrong", "no object", None]
    assert got[4].event.error == "stance: missing or wrong" and got[4].event.is_relevant is None


def test_early_stop_stream_equals_batch(spark, tmp_path):
    rows = [(u, p, (p * (u + 3)) % 7 < 4) for u in range(5) for p in range(1, 40)]
    df = spark.createDataFrame(rows, "user long, pos long, known boolean")
    df.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).json(str(tmp_path / "in"))
    q = ingest.early_stop(stream, "user", "pos", "known", 3).writeStream.format("memory").queryName("stops").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    batch = sequence.known_run(df, ["user"], ["pos"], F.col("known"), 3).where("stop_pos is not null")
    assert {(r.user, r.stop_pos) for r in spark.table("stops").collect()} == {(r.user, r.stop_pos) for r in batch.collect()}


def test_pick_element_takes_the_first_selector_that_matches():
    from plaza.functions.cards import Selector, pick_element

    page = "<div><meta itemprop=u content=' 5 '><p class='a b'>x<br> <b>y</b></p><a href=' /q '>z</a><p class=b>w</div>"
    assert pick_element(page, (Selector("h1"), Selector("p", "b"))) == ("xy", None)
    assert pick_element(page, (Selector("meta", attribute="itemprop"),)) == ("5", None)
    assert pick_element(page, (Selector("a", attribute="href"),)) == ("z", "/q")
    assert pick_element(page, (Selector("h1"),)) is None and pick_element(None, (Selector("a"),)) is None


def test_push_prompt_and_narrowing_refuse(spark):
    import pytest
    from plaza.operators import collection

    prompts = spark.sql("select 1L as version, 'a' as body, true as is_active")
    with pytest.raises(ValueError):
        collection.push_prompt(prompts, prompts.drop("is_active"))
    with pytest.raises(ValueError):
        collection.narrowed(spark.sql("select 'a' as type, 'b' as time"), types=("x",))
    assert collection.narrowed(spark.sql("select 'a' as type, 'b' as time"), types=("a",)).count() == 1


def test_append_log_is_read_by_scan_log(spark, tmp_path):
    rows = spark.createDataFrame([("u1", None, 3), ("u2", "t", 4)], "url string, title string, voteup_count int")
    for _ in range(2):
        jsonl.append_log(rows, f"file://{tmp_path}", "urls")
    got = jsonl.scan_log(spark, f"file://{tmp_path}", "urls").select("url", "title", "voteup_count").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("u1", None, 3), ("u2", "t", 4)] * 2, key=str)


def test_bodies_come_in_order(spark, tmp_path):
    for name, ids in (("contents", "cd"), ("answers", "ab")):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"url": u, "content_type": "answer"}) for u in ids))
    assert [r.url for r in jsonl.scan_bodies(spark, str(tmp_path)).orderBy("file_rank", "line_no").collect()] == ["a", "b", "c", "d"]


def test_parents_of_ids_that_clash(spark):
    from plaza.operators import gate

    def parents(*rows):
        df = spark.createDataFrame([(i, t, p, q, True, 100 + i) for i, (t, p, q) in enumerate(rows)], "ord long, content_type string, platform_id string, parent_platform_id string, inserted boolean, content_id long")
        return {r.ord: r.parent_content_id for r in gate.resolve_parents(df).collect()}

    assert parents(("x", "1", None), ("answer", "9", None), ("article", "9", None), ("comment", "5", "9"))[3] == 101  # no comment 9: the type that had the id first
    assert parents(("x", "1", None), ("comment", "9", None), ("answer", "9", None), ("comment", "5", "9"))[3] == 101  # its own type
    assert parents(("comment", "5", "9"), ("answer", "9", None))[0] is None  # not before its parent
    assert parents(("answer", "9", None), ("article", "9", None), ("answer", "9", None), ("comment", "5", "9"))[3] == 102  # the latest of that type


def test_the_last_judgment_counts(spark):
    from plaza.operators import gate

    records = spark.createDataFrame([("u", "answer", 1)], "url string, content_type string, question_id long")
    judgments = spark.createDataFrame([("u", True, "中立", 1), ("u", False, None, 2)], "url string, is_relevant boolean, platform_stance string, ord int")
    questions = spark.createDataFrame([(1,)], "question_id long")
    out = gate.content_disposition(records, judgments, questions, questions, "ord").collect()
    assert [(r.disposition, r.stance_conflict) for r in out] == [("kept_by_parent", True)]  # a null stance is a conflict


def test_a_crash_during_commit_leaves_the_last_version(spark, tmp_path, monkeypatch):
    s = store.Store(spark, f"file://{tmp_path}")
    schema = T.StructType.fromDDL("k long")
    s.commit("t", spark.createDataFrame([(1,)], schema))
    with monkeypatch.context() as m:
        m.setattr(store.Store, "marks", lambda self, table: 1 / 0)  # dies between data and mark
        with pytest.raises(ZeroDivisionError):
            s.commit("t", spark.createDataFrame([(2,)], schema))
    assert [r.k for r in s.read("t", schema).collect()] == [1]
    s.commit("t", spark.createDataFrame([(3,)], schema))
    assert [r.k for r in s.read("t", schema).collect()] == [3]


def test_numbering_by_ranges(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 as k")
    got = sequence.numbered(rows, ["k"], "n").collect()
    assert all(r.k == r.n for r in got) and len(got) == 1000
    assert sequence.numbered(rows.limit(0), ["k"], "n").count() == 0


def test_prescreen_reach(spark):
    text = " ".join(["of"] * 12 + ["to"] * 12 + ["ined"] * 12)  # "ined. of" is met from the last of on: over four times its trigrams
    content = spark.createDataFrame([(1, text), (2, "ined of")], "content_id long, title string")
    analysis = content.select("content_id", F.lit("").alias("ai_summary"))

    def score(reach):
        return {r.content_id: r.score for r in prescreen.prescreen(content, analysis, ["Ined. Of"], ["title", "ai_summary"], limit=None, reach=reach).collect()}

    def plain(reach):
        own, g = set(grams_of("Ined. Of")), grams_of(text)
        ends = lambda s: range(s + 1, min(len(g), s + reach * len(own)) + 1)
        return max(len(own & set(g[s:e])) / len(own | set(g[s:e])) for s in range(len(g)) for e in ends(s))

    assert plain(4) < plain(len(text)) and score(4) == {1: pytest.approx(plain(4), abs=1e-6), 2: 1.0}
    assert score(None) == {1: pytest.approx(plain(len(text)), abs=1e-6), 2: 1.0}


def test_prescreen_wants_a_judgment(spark):
    from plaza.operators import prescreen

    content = spark.createDataFrame([(1, "a station"), (2, "a station"), (3, "nothing")], "content_id long, title string")
    analysis = spark.createDataFrame([(1, None), (3, "the station")], "content_id long, ai_summary string")
    got = prescreen.prescreen(content, analysis, ["station"], ["title", "ai_summary"]).collect()
    assert [tuple(r) for r in got] == [(1, "station", 1.0), (3, "station", 1.0)]


def test_numbers_are_a_permutation_whatever_the_partitions(spark):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        rows = spark.range(200_000).select(F.xxhash64("id").alias("k"), F.concat(F.lit("x" * 40), F.col("id")).alias("wide"))
        got = sequence.numbered(rows, ["k"], "n")
        assert got.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n")).first() == (200_000, 200_000, 0, 199_999)
        out_of_order = got.withColumn("next", F.lead("k").over(Window.orderBy("n"))).where("next <= k")
        assert out_of_order.isEmpty()
        assert sum(sequence.shard(rows, ["k"], i, 3).count() for i in range(3)) == 200_000
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_of_two_writers_of_a_version_one_must_read_again(spark, tmp_path):
    schema = T.StructType.fromDDL("k int")
    one_, two = store.Store(spark, f"file://{tmp_path}"), store.Store(spark, f"file://{tmp_path}")
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], schema)
    read = lambda s: sorted(r.k for r in s.read("t", schema).collect())
    one_.commit("t", rows(1))
    assert read(one_) == read(two) == [1]
    one_.commit("t", rows(1, 2))
    with pytest.raises(store.Conflict):
        two.commit("t", rows(1, 3))
    assert read(two) == [1, 2]
    two.commit("t", rows(1, 2, 3))
    # old marks may go; numbers go on, a mark of a writer that died doesn't count
    (tmp_path / "t" / "marks" / "000000000001").unlink()
    (tmp_path / "t" / "marks" / "000000000004").write_text("")
    assert read(one_) == [1, 2, 3]
    one_.commit("t", rows(9))
    assert read(two) == [9] and two.marks("t")[-1] == 5

"""Prompts, runs, judgments and pages on small rows."""

import hashlib
import json
import random

import pytest
from plaza import schema
from plaza.functions import card_table, css, page, prompts, replies
from plaza.operators import collection, judge, judgments, mutations, rounds
from plaza.plans import checks, migrations
from plaza.sources import jsonl, runs
from pyspark.sql import functions as F


def test_prompt_bundles(spark):
    rows = [("v", m, f" {m} ", 0) for m in prompts.modules_of()] + [("v", "b_subject", " ", 1), ("v", "other", "x", 0), ("w", "c_tasks", 'say "ü\\"\n\t\x01', 3), ("w", "c_tasks", "old", 2), ("w", "a_role", None, 2)]
    for shuffled in (rows, rows[::-1]):
        made = prompts.bundles(spark.createDataFrame(shuffled, "key string, module string, body string, ord int"), "key", "ord")
        got = {r.key: r for r in made.select("key", prompts.prompt_hash(F.col("bodies")).alias("hash"), *(prompts.assemble(F.col("bodies"), t).alias(t) for t in ("content", "question", "event")), prompts.missing_modules(F.col("bodies")).alias("missing"), prompts.missing_modules(F.col("bodies"), "event").alias("of_event")).collect()}
        assert got["v"].question.split("\n\n") == ["a_role", "question_tasks", "question_rubric", "question_schema", "question_examples", "g_guardrails"]
        assert got["v"].missing == got["v"].of_event == ["b_subject"] and len(got["w"].missing) == 14 and got["w"].event == ""
        for key in "vw":
            last = {m: b or "" for k, m, b, o in sorted(rows, key=lambda r: r[3]) if k == key}
            text = json.dumps({m: last.get(m, "") for m in prompts.modules_of()}, ensure_ascii=False)
            assert got[key].hash == hashlib.sha256(text.encode()).hexdigest()[:16]
    with pytest.raises(ValueError):
        prompts.modules_of("other")


def test_runs_are_saved_and_listed(spark, tmp_path):
    root = f"file://{tmp_path}"
    assert runs.list_runs(spark, root).count() == 0 and runs.resume_run(spark, root, "a") is None
    for name in ("20260101-a", "20260102-b"):
        runs.save_state(spark, root, {"run_id": name, "mode": "update", "status": "open", "cursor": {"page": "1"}})
    runs.advance(spark, root, "20260101-a", keyword=5)
    (tmp_path / "20260103-c").mkdir()
    (tmp_path / "20260103-c" / "task.json").write_text('{"run_id": "half')
    assert [r.run_id for r in runs.list_runs(spark, root).collect()] == ["20260102-b", "20260101-a"]
    assert runs.resume_run(spark, root, "20260101-a")["cursor"] == {"page": "1", "keyword": "5"}
    assert runs.resume_run(spark, root, "20260103-c") is None
    (tmp_path / "keywords.jsonl").write_text('{"keyword": "b"}\n{"keyword": ""}\n{"keyword": "a"}\n{"x": 1}\n')
    assert [r.keyword for r in runs.load_keywords(spark, f"{root}/keywords.jsonl").collect()] == ["b", "a"]
    assert runs.load_keywords(spark, f"{root}/none.jsonl").count() == 0
    assert [tuple(r) for r in runs.run_status(spark, root, f"{root}/keywords.jsonl", 1).collect()] == [("20260102-b", "update", "open", 2)]
    runs.save_shard(spark, root, "ann", ["x", "y"])
    assert runs.load_shard(spark, root, "ann") == ["x", "y"] and runs.load_shard(spark, root, "bob") == []
    runs.write_workdir(spark, f"{root}/work", {"a_role": "r"})
    assert runs.read_workdir(spark, f"{root}/work", ("a_role", "b_subject")) == {"a_role": "r", "b_subject": ""}
    runs.write_report(spark, f"{root}/report.md", "Runs", runs.list_runs(spark, root).select("run_id"))
    assert "| 20260102-b |" in (tmp_path / "report.md").read_text()


def test_migrations_and_settings(spark, tmp_path):
    (tmp_path / "0002_b.sql").write_text("select 2;\r\n")
    (tmp_path / "0001_a.sql").write_text("select 1;\n")
    got = runs.discover_migrations(spark, f"file://{tmp_path}").collect()
    assert [(r.version, r.name) for r in got] == [(1, "0001_a.sql"), (2, "0002_b.sql")] and len(got[0].checksum) == 64
    (tmp_path / "x.sql").write_text("")
    with pytest.raises(ValueError):
        runs.discover_migrations(spark, f"file://{tmp_path}")
    assert runs.settings('A=1\n# B=2\nC="x # y"\n\nD = z # w\n', {"A": "9", "E": "5"}) == {"A": "9", "C": "x # y", "D": "z # w"}


def test_judgments_of_two_prompt_versions_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("u", "p2")], "url string, prompt_version string")
    written = spark.createDataFrame([("v", "p1")], "url string, prompt_version string")
    with pytest.raises(ValueError):
        judgments.append_judgments(rows, written, f"file://{tmp_path}", "contents")
    judgments.append_judgments(rows, written, f"file://{tmp_path}", "contents", force=True)
    assert jsonl.scan_log(spark, f"file://{tmp_path}", "contents").count() == 1


def plain_outcome(log, stable_rounds, max_nudges, max_rounds):
    total, stable, nudges = log[0][0], 0, 0
    for k, (new, at_end, early) in enumerate(log[1:], 1):
        if at_end:
            return "end_marker", k - 1, total, 0
        if early:
            return "early_stop", k - 1, total, nudges
        total += new
        stable = 0 if new else stable + 1
        if stable == stable_rounds:
            if nudges == max_nudges:
                return "gave_up" if nudges else "stable", k, total, nudges
            nudges, stable = nudges + 1, 0
        if k == max_rounds:
            return "max_rounds", k, total, nudges
    return None, len(log) - 1, total, nudges


@pytest.mark.parametrize(("stable", "nudges", "most"), [(3, 2, 500), (1, 0, 500), (2, 1, 12), (3, 0, 30)])
def test_scroll_outcomes_equal_the_state_machine(spark, stable, nudges, most):
    rng = random.Random(stable * 7 + most)
    logs = {i: [(rng.choice((0, 0, 1, 3)), rng.random() < 0.02, rng.random() < 0.02) for _ in range(rng.randint(1, 60))] for i in range(150)}
    rows = [(i, k, *r) for i, log in logs.items() for k, r in enumerate(log[: most + 1])]
    df = spark.createDataFrame(rows, "slice long, round_no int, new int, at_end boolean, early boolean")
    got = {r.slice: (r.stop_reason, r.rounds, r.total, r.nudges) for r in rounds.scroll_outcome(df, ["slice"], stable, nudges, most).collect()}
    assert got == {i: plain_outcome(log[: most + 1], stable, nudges, most) for i, log in logs.items()}


def test_an_answer_page_never_gives_another_answer(spark):
    cards = "".join(f"<div class='AnswerItem' name='{i}'><div class='RichText'>text {i}</div></div>" for i in (1, 2))
    df = spark.createDataFrame([(cards, "2"), (cards, "3"), ("<div class='RichText'>alone", "3")], "html string, id string")
    assert [r[0] for r in df.select(page.item(df.html, df.id)["body"]).collect()] == ["text 2", None, "alone"]


def test_update_event_tells_what_it_hit(spark):
    events = spark.createDataFrame([(1, "a", 1, False), (2, "b", 5, True)], "event_id long, name string, version int, backfill_scanned boolean")
    changes = spark.createDataFrame([(1, 1, None, True, None), (2, 1, "z", True, True), (3, 9, "q", True, None)], "ord int, event_id long, name string, bump boolean, backfill_scanned boolean")
    after, hit = mutations.update_event(events, changes)
    assert {tuple(r) for r in after.collect()} == {(1, "z", 3, True), (2, "b", 5, True)} and [r[0] for r in hit.collect()] == [1]


def test_state_of_a_page(spark):
    ok = json.dumps({"initialState": {"entities": {"pins": {"7": {"x": 1}}}}})
    pages = [f'<script id="js-initialData">{t}</script>' for t in (ok, "[1]", '{"initialState": 3}', "{")] + [None]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    state = page.initial_state(df.html)
    assert [r[0] for r in df.select(state.isNotNull()).collect()] == [True, False, False, False, False]
    assert [r[0] for r in df.select(page.entity(state, F.lit("thought"), F.lit("7")).isNotNull()).collect()][0]


def test_requests_are_repeated_where_waiting_may_help():
    def failing(*errors):
        left = list(errors)

        def ask(text):
            if left:
                raise left.pop(0)
            return text

        return ask

    waits = []
    assert judge.patient(failing(judge.Status(429), TimeoutError()), wait=waits.append)("x") == "x" and waits == [1.5, 2.25]
    for errors, kind, n in [((judge.Status(503),) * 3, judge.Status, 2), ((judge.Status(401),), judge.Status, 0), ((ValueError(),), ValueError, 0)]:
        waits.clear()
        with pytest.raises(kind):
            judge.patient(failing(*errors), wait=waits.append)("x")
        assert len(waits) == n


def test_keywords_are_collected_one_by_one(spark, tmp_path):
    root = f"file://{tmp_path}"
    assert runs.collect_keywords(spark, root, "r", ["a ", " ", "b"], len) == 2
    state = runs.resume_run(spark, root, "r")
    assert (state["status"], state["cursor"]) == ("done", {"keyword_index": "2"})
    assert sorted((r.keyword, r.result_count) for r in jsonl.scan_log(spark, f"{root}/r", "runs").collect()) == [("a", 1), ("b", 1)]
    with pytest.raises(ZeroDivisionError):
        runs.collect_keywords(spark, root, "s", ["a", "b"], lambda k: 1 // (k == "a"))
    state = runs.resume_run(spark, root, "s")
    assert (state["status"], state["cursor"]) == ("failed", {"keyword_index": "1"})
    with pytest.raises(ValueError):
        runs.collect_keywords(spark, root, "t", [" "], len)
    done, error = runs.one_by_one([1, 0, 2], lambda x: 1 // x)
    assert done == [1] and isinstance(error, ZeroDivisionError)


def test_snapshots_of_equal_texts_are_equal_bytes(spark, tmp_path):
    paths = [runs.save_snapshot(spark, f"file://{tmp_path}/{n}.html", "<p>é</p>") for n in "ab"]
    assert (tmp_path / "a.html.gz").read_bytes() == (tmp_path / "b.html.gz").read_bytes() == runs.packed_text("<p>é</p>")
    assert paths[0].endswith("a.html.gz") and runs.save_snapshot(spark, "nowhere://x/y", "z") is None


def test_selectors_and_specs_are_checked_before_a_round(spark):
    selectors = {"card": ".card", "title": "TODO-.title", "date": ""}
    assert checks.uncalibrated(selectors, ["date", "votes", "card"]) == ["date", "title", "votes"]
    checks.require_calibrated(selectors, ["card"], ["date"])
    with pytest.raises(ValueError):
        checks.require_calibrated(selectors, ["card", "title"])
    fine = spark.createDataFrame([("综合排序", None, "只看视频")], "sort string, time string, type string")
    assert collection.checked_specs(fine) is fine
    with pytest.raises(ValueError):
        collection.checked_specs(fine.withColumn("time", F.lit("三个月内")))


def test_drift_is_shown_and_accepted_with_a_note(spark, tmp_path):
    path = f"file://{tmp_path}/applied"
    assert migrations.tracking_state(spark, path).count() == 0
    spark.createDataFrame([(1, "x"), (2, "y")], "version int, checksum string").write.parquet(path)
    assert sorted(map(tuple, migrations.tracking_state(spark, path).collect())) == [(1, "x", None), (2, "y", None)]
    files = spark.createDataFrame([(1, "x", "one"), (2, "z", "a\nc"), (3, "w", "three")], "version int, checksum string, sql string")
    stored = migrations.with_texts(files, migrations.tracking_state(spark, path))
    assert sorted((r.version, r.applied_sql) for r in stored.collect()) == [(1, "one"), (2, None)]
    known = spark.createDataFrame([(1, "x", "one"), (2, "y", "a\nb")], "version int, checksum string, applied_sql string")
    [found] = migrations.drift(files, known).collect()
    assert found.version == 2 and found.diff.split("\n")[-2:] == ["-b", "+c"]
    after = migrations.accept_drift(files, known, 2, " typo ")
    assert sorted(map(tuple, after.collect())) == [(1, "x", "one", None), (2, "z", "a\nc", "typo")]
    assert migrations.migration_plan(files, after).where("blocked").isEmpty()
    for version, note in ((2, " "), (1, "n"), (3, "n")):
        with pytest.raises(ValueError):
            migrations.accept_drift(files, known, version, note)


# --- results mended, each by the case that showed it ---


def test_a_body_is_the_candidate_written_first(spark):
    html = "<h1>h</h1><div class='RichText'>side box</div><div class='Post-RichText'>the body</div><meta itemprop='headline' content='told'>"
    got = spark.createDataFrame([(html,)], "h string").select(page.item(F.col("h"))).first()[0]
    assert (got.body, got.title) == ("the body", "told")


def test_a_claim_leaves_relevance_open_and_tells_who_came_first(spark):
    now = spark.createDataFrame([(3, "old", True)], "question_id long, platform_qid string, is_relevant boolean")
    claims = spark.createDataFrame([(1, "b", True), (0, "a", True), (2, "a", False), (3, "old", False)], "ord int, platform_qid string, is_relevant boolean")
    after, first = mutations.claim_questions(now, claims)
    assert sorted(map(tuple, after.collect())) == [(3, "old", True), (4, "a", None), (5, "b", None)]
    assert sorted(map(tuple, first.collect())) == [(0, "a", 4), (1, "b", 5)]


def test_migration_names_in_capitals_are_refused(spark, tmp_path):
    (tmp_path / "0001_ok_2.sql").write_text("x")
    assert [r.version for r in runs.discover_migrations(spark, f"file://{tmp_path}").collect()] == [1]
    for bad in ("0002_Foo.sql", "2_foo.sql", "0002.sql", "0002_.sql"):
        (tmp_path / bad).write_text("x")
        with pytest.raises(ValueError, match="migration names"):
            runs.discover_migrations(spark, f"file://{tmp_path}")
        (tmp_path / bad).unlink()


def test_each_broken_column_of_a_row_counts(spark):
    df = spark.createDataFrame([("x", "y"), ("a", None), ("x", "b")], "p string, q string")
    got = schema.enum_violations(df, {"p": ("a",), "q": ("b",)})
    assert sorted(map(tuple, got.groupBy("violated").count().collect())) == [("p", 2), ("q", 1)]


def test_wrong_types_aren_t_missing_fields(spark):
    rows = [('{"s": " t ", "f": 0.5}', ("t", None), (0.5, None)), ('{"s": null}', (None, None), (None, None)), ('{"s": " ", "f": 1}', (None, None), (1.0, None)), ('{"s": 3, "f": "0.5"}', (None, "wrong_type"), (None, "wrong_type")), ('{"s": [], "f": true}', (None, "wrong_type"), (None, "wrong_type")), ('{"f": 1.01}', (None, None), (None, "out_of_range"))]
    df = spark.createDataFrame([(r[0],) for r in rows], "raw string").withColumn("r", replies.parse_reply(F.col("raw"))).select(replies.optional_str(F.col("r"), "s").alias("s"), replies.optional_float(F.col("r"), "f").alias("f"))
    assert [(tuple(x.s), tuple(x.f)) for x in df.collect()] == [r[1:] for r in rows]


def test_a_judgment_by_the_last_title_stays(spark):
    questions = lambda titles: spark.createDataFrame([(i, "q", t) for i, t in enumerate(titles)], "ord int, platform_qid string, title string")
    bodies = spark.createDataFrame([(0, "f", "u", "answer", "1", "q", None, "x"), (1, "f", "u", "answer", "2", "q", None, "x"), (2, "g", "", "answer", "3", None, None, "nation")], "ord int, file string, url string, content_type string, platform_id string, platform_qid string, title string, text string")
    for titles, relevant in ((["a none", "z nation"], True), (["z nation", "a none"], False)):
        got = checks.replay(bodies, questions(titles), [("nation", True, "s", "r")], (False, "s", "low")).orderBy("ord").collect()
        assert [(r.fate, r.risk_level, r.question_relevant) for r in got] == [("inserted", "low", relevant), ("duplicate", "low", relevant), ("unbuildable", None, None)]


# --- selectors and cards ---


@pytest.mark.parametrize(
    ("group", "found"),
    [
        ("i, b", ["B1", "B2"]), (".y, .x", ["A"]), ("#one .x", ["A"]), ("#one > .x", []), ("div > p.x", ["A"]), ("[data-k]", ["A", "B1"]), ("[data-k='2']", ["B1"]), ('b[data-k*="2"], b', ["B1"]), ("a[href^='/p/'], b", ["L"]), ("a[href$=x]", []),
        ("nav li > a[href]", ["L", "M"]), ("*[data-k] b", []), ("", []), ("section div p b", ["B2"]), ("i", []),
    ],
)
def test_css_groups(group, found):
    html = "<section id='one'><div><p class='x z' data-k='1'>A</p><p><b>B2</b></p></div></section><b data-k='2'>B1</b><nav><ul><li><a href='/p/1'>L</a><li><a href='/q'>M</a></ul></nav>"
    got = css.group(group).all(page.tree(html))
    assert sorted(n.text() for n in got) == sorted(found)
    assert (css.group(group).first(page.tree(html)) is None) == (not found)
    for bad in ("> a", "a >", "a[", "a::x", "a:not(b)"):
        with pytest.raises(ValueError, match="selector"):
            css.group(bad)


CARD = "<div class='ContentItem'><h2 class='ContentItem-title'>{link}</h2><div class='RichText'>excerpt</div><button aria-label='赞同 17 '></button><div class='ContentItem-action'>赞同 17   2.5 万 条评论 08-31</div></div>"


def test_cards_are_rows_and_their_fates_add_up(spark):
    search = "".join(CARD.format(link=x) for x in ("<a href='//zhuanlan.zhihu.com/p/5'>t</a>", "<a href='/question/1/answer/2'>u</a>", "<a name='x'>no</a>", "<a href='/people/w'>p</a>"))
    pages = spark.createDataFrame([(1, search), (2, None), (3, "<p>none</p>")], "page_id int, html string")
    got = card_table.cards(pages, "search").orderBy("page_id", "ord").collect()
    assert [(r.page_id, r.ord, r.fate, r.content_type, r.platform_id, r.title) for r in got] == [(1, 0, "kept", "article", "5", "t"), (1, 1, "kept", "answer", "2", "u"), (1, 2, "no_link", None, None, None), (1, 3, "not_content", None, None, "p")]
    assert (got[0].voteup_count, got[0].comment_count, got[0].text) == (17, 25_000, "excerpt")
    assert {r.fate: r.n for r in card_table.fates(card_table.cards(pages, "search")).collect()} == {"kept": 2, "no_link": 1, "not_content": 1}

    answer = "<div class='AnswerItem' name='9'>{}<span itemprop='author'><a class='UserLink-link' href='/people/w'><b class='AuthorInfo-name'>w</b></a></span><div class='RichText'>b <a href='/question/4/answer/44'>other</a></div></div>"
    pages = spark.createDataFrame([(1, answer.format("<meta itemprop='url' content='https://www.zhihu.com/question/3/answer/9'>") + answer.format("<a href='/question/7/answer/9/'>me</a>") + answer.format("")), (2, "<div class='AnswerItem'>x</div>")], "page_id int, html string")
    got = card_table.cards(pages, "answer", question_id=F.lit("5")).orderBy("page_id", "ord").collect()
    assert [(r.fate, r.card_url) for r in got] == [("kept", f"https://www.zhihu.com/question/{q}/answer/9") for q in (3, 7, 5)] + [("no_address", None)]
    assert (got[0].author_name, got[0].author_platform_id, got[0].author_url) == ("w", "w", "https://www.zhihu.com/people/w")

    link = "<a href='/people/a'></a><a href='/people/a'>ann</a>"
    comments = f"<div data-id='c1'>{link}<div class='CommentContent'>hi</div><div data-id='c2'>{link}<div class='CommentContent'>reply</div></div></div><div data-id='c3'><div class='CommentContent'>nobody</div></div><div data-id=''>{link}<div class='CommentContent'><img></div></div>"
    got = card_table.cards(spark.createDataFrame([(comments,)], "html string"), "comment").orderBy("ord").collect()
    assert [(r.fate, r.platform_id, r.text, r.author_name) for r in got] == [("kept", "c1", "hi", "ann"), ("no_author", None, "nobody", None), ("empty", None, None, "ann")]

    pages = spark.createDataFrame([("https://zhuanlan.zhihu.com/p/8", "<meta itemprop='datePublished' content='2024-05-06T07:08:09Z'><h1 class='Post-Title'>T</h1><div class='Post-RichText'>whole</div>"), ("/people/x", "<p>")], "at string, html string")
    got = card_table.cards(pages, "content", url="at").orderBy("fate").collect()
    assert [(r.fate, r.platform_id, r.title, r.text, str(r.published_at)) for r in got] == [("kept", "8", "T", "whole", "2024-05-06 07:08:09"), ("not_content", None, None, None, "None")]


def test_page_items_and_sql_on_cut_references(spark, tmp_path):
    import duckdb
    from plaza import catalog

    titles = ["a&amp;b &amp", "&amp", "x&am", "y&", "&quot;z&quot", "&amp;lt; &lt", "&&amp;&amp", None, "plain", "&ampx; &amp;amp;", "&nosuch; &lt;b&gt"]
    rows = [(i, f"<html><body><h1 class='t'>{t}</h1><p>&amp</p></body></html>" if t is not None else None) for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    sql = catalog.SQL["page_items"]
    want = con.execute(sql[sql.index("select page_id, nullif") :]).fetchall()
    got = [tuple(r) for r in catalog.QUERIES["page_items"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert spark.createDataFrame(rows, "page_id long, html string").where("page_id = 0").select(page.item(F.col("html"))["title"]).first()[0] == "a&b &"  # the operator, as browsers

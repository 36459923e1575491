"""The transformation against plain regular expressions, and read back."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plaza.llm import fill_in_middle as fim
from plaza.llm import queries
from pyspark.sql import functions as F

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
RULES = fim.Rules()


def draws(doc, seed=42):
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    return [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]


def brute(text, h, rules=RULES):
    text = text or ""
    u = UNIT.findall(text)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(s in text for s in (rules.prefix, rules.suffix, rules.middle)) or h[2] % 100 >= rules.changed:
        return len(u), "plain", None, None, text
    p, s, m = rules.prefix, rules.suffix, rules.middle
    return (len(u), "spm", len(pre), len(mid), s + suf + p + pre + m + mid) if h[3] % 100 < rules.spm else (len(u), "psm", len(pre), len(mid), p + pre + s + suf + m + mid)


def test_query_equals_brute_force(spark, small, table):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_fill_in_middle(spark, small).collect()}
    docs = table(small, "documents")
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        *head, out = brute(d["text"], draws(d["doc_id"]))
        assert got[d["doc_id"]] == (*head, sha(out), sha(d["text"] or ""))
    assert {x[1] for x in got.values()} == {"plain", "psm", "spm"}


PIECES = ["<", "P", ">", "<P>", "<S", "M>", " ", "\n", "\x0b", "\x1f", "a", "é", "日", "😀", "\x00", " ", "word"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=1, max_size=8), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))
def test_any_texts(texts, h):
    scanner = fim.Scanner(RULES.sentinels)
    made = fim.transformed([t.encode() for t in texts], np.array([h] * len(texts)).T, RULES, scanner)
    assert list(zip(*(c.to_pylist() for c in made), strict=True)) == [brute(t, h) for t in texts]


def marks_one_by_one(scanner, data):
    state, out = scanner.start, []
    for b in data.tolist():
        out.append(scanner.marks[state, b])
        state = int(scanner.next[state, b])
    return out


@pytest.mark.parametrize("lanes", [1, 2, 7, 4096])
def test_lanes_give_what_one_walk_gives(monkeypatch, lanes):
    monkeypatch.setattr(fim, "LANES", lanes)
    rng = np.random.default_rng(lanes)
    data = np.frombuffer("".join(rng.choice(PIECES, 20_000)).encode() + b"\xff" + b"<P" * 300 + b"\xff\xff\xff", np.uint8)
    for sentinels in (RULES.sentinels, (b"<|prefix|>", b"<|suffix|>", b"<|mid|>")):
        scanner = fim.Scanner(sentinels)
        assert scanner.scan(data).tolist() == marks_one_by_one(scanner, data)


def test_read_back_with_other_rules(spark, small):
    rules = fim.Rules(seed=7, prefix="[pre]", suffix="[suf]", middle="[mid]", changed=100, spm=30)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    again = fim.transform(docs, rules).withColumn("back", fim.restored(F.col("fim_text"), F.col("fim_form"), rules))
    assert again.where("fim_form <> 'plain'").count() > 150
    assert again.where("back <> coalesce(text, '') or back is null").count() == 0
    for bad in (("a", "a", "b"), ("ab", "b", "c"), ("", "b", "c")):
        with pytest.raises(ValueError, match="sentinels"):
            fim.Rules(0, *bad)


def test_odd_rows(odd, empty):
    clash = odd.withColumnRenamed("score", "fim_draw_0").withColumnRenamed("n_words", "fim_text")
    got = fim.transform(clash)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "fim_draw_0", *(f.name for f in fim.FIELDS)]
    rows = got.collect()
    assert len(rows) == odd.count() and {r.fim_draw_0 for r in rows} == {"clash"}
    for r in rows:
        assert tuple(r)[6:] == brute(r.text, draws(r.doc_id))
    assert fim.transform(empty).count() == 0

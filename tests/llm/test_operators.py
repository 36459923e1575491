"""Each operator against brute force on small tables, and on odd rows."""

import hashlib
import math
import os
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from plaza.llm import asking, chat_format, common, components, decontaminate, jaccard_join, language_id, lm_score, mixing, pii, quality, queries, substring_dedup, token_counts
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(i, of):
    return zlib.crc32(str(i).encode()) % of


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- 1 ---


def test_token_counts_equal_a_plain_lattice(spark, small, table):
    tokenizers = pytest.importorskip("tokenizers")
    pieces = token_counts.load_pieces(queries.PIECES)
    got = by_id(queries.op1_token_counts(spark, small))
    vocab = [("<unk>", -1e4)] + list(pieces.items())
    unigram = tokenizers.Tokenizer(tokenizers.models.Unigram(vocab, 0, False))
    for row in table(small, "documents")[:60]:
        words = WORD.findall(row["text"] or "")
        assert got[row["doc_id"]].n_pretokens == len(words)
        if all(all(c in pieces for c in w) for w in words):  # without spelled-out characters the library's own unigram model counts the same
            assert got[row["doc_id"]].n_tokens == sum(len(unigram.encode(token_counts.MARK + w).ids) for w in words)


def test_token_counts_share_prefixes_and_survive_clearing(monkeypatch):
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -2.2, "▁a": -2.1, "aba": -3.0}

    def plain(word):
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
        counter = token_counts.TrieCounter(pieces)
        for i in range(1, len(word) + 1):
            for k in range(i, 0, -1):
                piece = word[i - k : i]
                own = pieces.get(piece, len(piece.encode()) * counter.byte if k == 1 else None)
                if own is not None and best[i - k][0] + own > best[i][0]:
                    best[i] = (best[i - k][0] + own, best[i - k][1] + (1 if piece in pieces else len(piece.encode())))
        return best[-1][1]

    words = ["▁ab", "▁aba", "▁abab", "▁xé", "▁" + "ab" * 300, "▁a"]
    counter = token_counts.TrieCounter(pieces)
    assert [counter.count(w) for w in words] == [plain(w) for w in words]
    monkeypatch.setattr(token_counts, "MAX_NODES", 8)
    tight = token_counts.TrieCounter(pieces)
    assert [tight.count(w) for w in words * 2] == [plain(w) for w in words * 2]


def test_token_counts_look_no_further_than_pieces_end():
    class Probed(dict):
        n = 0

        def get(self, key, default=None):
            Probed.n += 1
            return super().get(key, default)

    pieces = {"a": -1.0, "b": -1.5, "abcdefghijklmnop": -2.0, "op": -2.5}
    counter = token_counts.TrieCounter(pieces)
    for name in ("pieces", "ends"):
        if hasattr(counter, name):
            setattr(counter, name, Probed(getattr(counter, name)))
    words = ["▁" + "ab" * 60, "▁" + "xb" * 60, "▁" + "ab" * 300]
    assert [counter.count(w) for w in words] == [3 + 120, 3 + 120, 3 + 600]
    assert Probed.n <= 2.5 * sum(map(len, words))  # the longest piece has 16 characters
    assert counter.count("abcdefghijklmnop") == 1 and counter.count("bcdefghijklmnop") == 1 + 12 + 1


def test_token_counts_of_odd_rows(odd, empty):
    pieces = {token_counts.MARK: -3.0, "x": -2.0, "the": -2.5, token_counts.MARK + "the": -2.2}
    got = token_counts.count_tokens(odd, pieces).collect()
    assert len(got) == odd.count() and "clash" in {r.score for r in got}
    assert all(r.n_pretokens == len(WORD.findall(r.text or "")) for r in got)
    assert all((r.n_tokens == 0) == (r.n_pretokens == 0) for r in got)
    long = next(r for r in got if r.doc_id == 6)
    assert long.n_tokens == 60_000 * 2 + 4  # mark and x each; the mark and three bytes of "end"
    assert token_counts.count_tokens(empty, pieces).count() == 0


# --- 2 ---


def test_language_id_on_held_out_documents(spark, medium, table):
    got = by_id(queries.op2_language_id(spark, medium))
    docs = table(medium, "documents")
    assert len(got) == len(docs)
    held = [d for d in docs if crc(d["doc_id"], 4) == 2 and d["lang"]]
    assert all(got[d["doc_id"]].held_out == (crc(d["doc_id"], 4) == 2) for d in docs)
    assert all(0 <= r.score <= 1 for r in got.values())
    sure = [d for d in held if not got[d["doc_id"]].rejected]
    assert len(sure) >= 0.95 * len(held)
    assert sum(got[d["doc_id"]].lang_pred == d["lang"] for d in sure) >= 0.98 * len(sure)


def test_language_id_without_letters_or_languages(spark, odd, empty):
    dictionaries = language_id.train_dictionaries(odd)
    got = language_id.identify(odd, dictionaries).collect()
    assert [r.lang_pred for r in got if r.doc_id in (3, 4, 5, 7)] == ["und"] * 4
    assert len(got) == odd.count()
    assert {r.lang_pred for r in language_id.identify(odd, []).collect()} == {"und"}
    assert language_id.train_dictionaries(empty) == []
    assert language_id.identify(empty, dictionaries).count() == 0


# --- 3 ---


def test_substring_dedup_finds_planted_passages(spark):
    rng = np.random.default_rng(5)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))
    passages = [word(60) for _ in range(20)]
    rows = [(i, f"{word(int(rng.integers(5, 200)))} {passages[i % 20]} {word(40)}") for i in range(60)] + [(100 + i, word(300)) for i in range(40)]
    rows += [(200, f"{word(30)} {(own := word(70))} {word(9)} {own} {word(20)}")]
    got = by_id(substring_dedup.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert set(got) == {*range(60), 200}
    assert all(30 <= got[i].repeated_words <= 60 for i in range(60))
    assert all(got[i].removed_words == 0 if i < 20 else got[i].removed_words >= 30 for i in range(60))
    assert got[200].removed_words >= 40 and got[200].repeated_words == 2 * got[200].removed_words  # a repeat within one document
    left = by_id(substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(len(left[i].text.split()) == len(t.split()) - (got[i].removed_words if i in got else 0) for i, t in rows)


def test_substring_dedup_recall_by_length(spark):
    rng = np.random.default_rng(6)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9)))) for _ in range(n))
    rows, lengths = [], (30, 40, 51, 60, 80)
    for k in range(200 * len(lengths)):
        passage = word(lengths[k % 5])
        rows += [(2 * k + i, f"{word(60)} {passage} {word(60)}") for i in range(2)]
    got = by_id(substring_dedup.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    for j, (length, found, covered) in enumerate(zip(lengths, (0.4, 0.9, 0.985, 0.985, 0.985), (0.3, 0.65, 0.74, 0.78, 0.83))):
        words = [got[2 * k + 1].removed_words if 2 * k + 1 in got else 0 for k in range(j, 1000, 5)]
        assert np.mean([w > 0 for w in words]) >= found and np.mean(words) / length >= covered, length


def brute_chunks(text, reach=substring_dedup.REACH):
    """(chunk, first word, end word) by the definition: gear hashes rolled byte by byte, each word end compared with its neighbours."""
    data, h, hashes, ends = text.encode(), 0, [], []
    blank = b" \t\n\r\x0b\x0c"
    for i, b in enumerate(data):
        h = ((h << 2) + int(substring_dedup.GEAR[b])) & 0xFFFFFFFF
        if b not in blank and (i + 1 == len(data) or data[i + 1] in blank):
            hashes.append(h)
            ends.append(i + 1)
    cuts = [k for k in range(len(ends) - 1) if all(hashes[k] > x for x in hashes[max(0, k - reach) : k]) and all(hashes[k] >= x for x in hashes[k + 1 : k + 1 + reach])]
    out, byte, word = [], 0, 0
    for k in [*cuts, len(ends) - 1] if ends else ():
        out.append((data[byte : ends[k]].strip(), word, k + 1))
        byte, word = ends[k], k + 1
    return out


def brute_passages(marked, chunks):
    out, run = [], []
    for m, (_, a, b) in [*zip(marked, chunks), (False, (b"", 0, 0))]:
        if m:
            run += [a, b]
        else:
            if run and run[-1] - run[0] >= substring_dedup.MIN_WORDS:
                out.append((run[0], run[-1]))
            run = []
    return out


def brute_repeats(docs):
    """docs: id -> text."""
    chunks = {i: brute_chunks(t) for i, t in docs.items()}
    places = defaultdict(list)
    for i in sorted(chunks):
        for c, a, _ in chunks[i]:
            places[c].append((i, a))
    out = {}
    for i, own in chunks.items():
        twice = [len(places[c]) > 1 for c, _, _ in own]
        if spans := brute_passages(twice, own):
            out[i] = (spans, brute_passages([t and (i, a) != places[c][0] for t, (c, a, _) in zip(twice, own)], own))
    return out


@pytest.mark.parametrize("block", [substring_dedup.BLOCK_BYTES, 20_000])
def test_substring_dedup_equals_brute_force(spark, small, table, monkeypatch, block):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(asking, "PART_ENTRIES", block // 40)
    want = brute_repeats({d["doc_id"]: d["text"] or "" for d in table(small, "documents")})
    got = by_id(queries.op3_substring_dedup(spark, small))
    written = lambda spans: ",".join(f"{a}:{b}" for a, b in spans)
    words = lambda spans: sum(b - a for a, b in spans)
    assert {i: tuple(r)[1:] for i, r in got.items()} == {i: (words(s), words(r), written(s), written(r)) for i, (s, r) in want.items()}
    assert len(want) > 20


def test_substring_dedup_chunks_equal_the_definition(small, table):
    texts = [d["text"] or "" for d in table(small, "documents")[:80]] + ["", " ", "a", " a b ", "x " * 50]
    for t in texts:
        starts, words = substring_dedup.chunks_of(t.encode())
        assert [(t.encode()[a:b].strip(), p, q) for a, b, p, q in zip(starts, starts[1:], words, words[1:])] == brute_chunks(t)


def test_substring_dedup_odd_rows(spark, odd, empty):
    got = by_id(substring_dedup.find_repeats(odd))
    assert set(got) <= {6}  # 13 words are no passage; the null id isn't looked at
    assert substring_dedup.find_repeats(empty).count() == 0
    assert substring_dedup.remove_repeats(odd).count() == odd.count()


# --- 4 ---


def brute_sets(docs):
    out = {}
    for i, t in docs:
        w = WORD.findall(lower(t))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def brute_links(sets_):
    ids, by = sorted(sets_), defaultdict(set)
    for i in ids:
        for s in sets_[i]:
            by[s].add(i)
    links = defaultdict(set)
    for i in ids:
        near = Counter(j for s in sets_[i] for j in by[s] if j != i)
        links[i] = {j for j, n in near.items() if 100 * n >= 75 * (len(sets_[i]) + len(sets_[j]) - n)}
    comp = {}
    for i in ids:
        if i not in comp:
            todo, comp[i] = [i], i
            while todo:
                for j in links[todo.pop()]:
                    if j not in comp:
                        comp[j] = i
                        todo.append(j)
    return links, comp


@pytest.mark.parametrize("size", ["small", "medium"])
def test_jaccard_join_equals_brute_force(spark, size, table, request):
    folder = request.getfixturevalue(size)
    sets_ = brute_sets([(d["doc_id"], d["text"]) for d in table(folder, "documents")])
    links, comp = brute_links(sets_)
    got = by_id(queries.op4_jaccard_join(spark, folder))
    assert {i: (r.n_shingles, r.component_id, r.n_links) for i, r in got.items()} == {i: (len(s), comp[i], len(links[i])) for i, s in sets_.items()}


def test_jaccard_join_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "RUN", 6000)  # several runs to a block
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):
        base = [f"w{g}x{k}" for k in range(int(rng.integers(4, 120)))]
        for _ in range(30):
            w = list(base)
            for _ in range(int(rng.integers(0, 1 + len(w) // 9))):
                w[int(rng.integers(len(w)))] = f"r{rng.integers(1 << 40)}"
            rows.append((len(rows), " ".join(w[: len(w) - int(rng.integers(0, 1 + len(w) // 6))])))
    links, comp = brute_links(brute_sets(rows))
    got = by_id(jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.component_id, r.n_links) for i, r in got.items()} == {i: (comp[i], len(links[i])) for i, _ in rows}
    kept = jaccard_join.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comp.values()))


def test_signatures_prune_most_of_what_sizes_leave(medium, table):
    """All distinct sets of a table in one task: leaf pairs that sizes alone allow, and of those the ones that signatures allow."""
    sets_ = {s.tobytes(): s for d in table(medium, "documents") if len(s := jaccard_join.shingles_of((d["text"] or "").encode()))}
    tokens = sorted(sets_.values(), key=lambda s: (s[0], len(s)))
    side, _, n = jaccard_join.sides(tokens, None)
    tree = jaccard_join.Tree(side, jaccard_join.bits_for(side, n))
    leaves = tree.levels[0]
    by_size = [(x, y) for i, x in enumerate(leaves) for y in leaves[i:] if jaccard_join.sizes_allow(x, y, 75)]
    left = sum(jaccard_join.signatures_allow(x, y, 75) for x, y in by_size)
    assert len(by_size) > 500 and left < 0.5 * len(by_size)
    visited = list(jaccard_join.traverse(tree, tree, True, 75))
    assert len(visited) == len(set(visited)) == left


def test_jaccard_join_of_texts_that_share_an_id(spark):
    words = [f"w{k}" for k in range(40)]
    near = lambda i: " ".join([*words[:39], f"x{i}"])
    rows = [(5, near(1)), (5, near(2)), (6, near(3)), (6, "a text of its own, not like any of the others"), (7, near(3)), (7, near(3)), (8, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == Counter([(5, 36, 5, 3), (5, 36, 5, 3), (6, 36, 5, 3), (6, 7, 6, 0), (7, 36, 5, 3), (7, 36, 5, 3), (8, 1, 8, 0)])
    kept = Counter(tuple(r) for r in jaccard_join.keep_first(docs).collect())
    assert kept[6, rows[3][1]] == kept[8, "short"] == 1 and sum(kept.values()) == 3 and sum(n for (i, _), n in kept.items() if i == 5) == 1


def test_jaccard_join_odd_rows(spark, odd, empty):
    got = jaccard_join.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by[1].component_id, by[2].component_id, by[1].n_links, by[2].n_links) == (1, 1, 1, 1)
    assert all(by[i].n_shingles == 0 and by[i].component_id == i for i in (3, 4, 5))
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.keep_first(odd).count() == odd.count() - 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 100), (7, 7), (60, 62), (62, 61)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99, 60: 60, 61: 60, 62: 60}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_around_nodes_with_many_edges(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    edges = [(5000, i) for i in range(300)] + [(300 + i, 5001) for i in range(200)] + [(7000, 7001)] + [(299, 300)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys([*range(500), 5000, 5001], 0), 7000: 7000, 7001: 7000}


def test_jaccard_join_with_many_copies_of_a_text(spark, small, table, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    docs = [(d["doc_id"], d["text"]) for d in table(small, "documents")]
    docs += [(10_000 + i, docs[0][1]) for i in range(100)] + [(20_000 + i, docs[1][1] + f" end {i}") for i in range(30)]
    links, comp = brute_links(brute_sets(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = by_id(jaccard_join.near_duplicates(df))
    assert {i: (r.component_id, r.n_links) for i, r in got.items()} == {i: (comp[i], len(links[i])) for i, _ in docs}
    assert sorted(r.doc_id for r in jaccard_join.keep_first(df).collect()) == sorted(i for i, c in comp.items() if i == c)


# --- 5 ---


def test_chat_format_reads_back(spark, small, table):
    got = by_id(queries.op5_chat_format(spark, small), "conv_id")
    rows = table(small, "conversations") + [{"conv_id": -7, "turn": k, "role": r, "text": queries.TRICKY} for k, r in enumerate(("user", "assistant"))]
    threads = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        threads[r["conv_id"]].append((r["role"], r["text"] or ""))
    assert set(got) == set(threads)
    for i, turns in threads.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert got[i].n_turns == len(turns)
        assert got[i].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (got[i].loss_chars, got[i].loss_sha256) == (len(said), sha(said))


def test_reply_trees_rank_branches(spark):
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", -1.0), (1, 3, 1, "assistant", "good <b>\\l", 2.0), (1, 4, 3, "user", None, 1.0), (1, 5, 9, "user", "lost parent", 0.5), (2, 1, 2, "user", "cycle", 0.0), (2, 2, 1, "user", "cycle", 0.0), (None, 1, None, None, "x", None)]
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    got = {(r.tree, r["rank"]): r for r in chat_format.format_trees(df, best=2).collect()}
    assert {k: v.leaf for k, v in got.items()} == {(1, 1): 4, (1, 2): 5, (None, 1): 1}
    first = got[1, 1]
    assert first.formatted == "<turn user>q</turn>\n<turn assistant>good \\lb\\g\\bl</turn>\n<turn user></turn>\n"
    assert [first.formatted[s.start : s.end] for s in first.loss] == ["good \\lb\\g\\bl"]
    assert {tuple(r.path) for r in chat_format.paths(df).where("tree = 1").collect()} == {(1, 2), (1, 3, 4), (5,)}
    assert chat_format.format_trees(df.limit(0)).count() == 0


def test_long_threads_and_repeated_turns(spark):
    """A thread of 5,000 turns, ties in turn, repeated rows, null turns and roles, an extra column named like an output."""
    rows = [(1, k, "user" if k % 2 else "assistant", f"t{k} <", "x") for k in range(5000)] + [(2, 0, "user", "a", "x")] * 3 + [(2, 0, "assistant", "b", "x"), (2, None, None, None, "x"), (2, 1, "assistant", "", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    nodes = chat_format.threads(df)
    got = by_id(chat_format.format_trees(nodes).select("tree", "n_turns", "formatted", "loss", chat_format.read_back(F.col("formatted")).alias("back"), chat_format.read_loss(F.col("formatted"), F.col("loss")).alias("said")), "tree")
    assert [tuple(t) for t in got[1].back] == [(r, t) for _, _, r, t, _ in rows[:5000]]
    assert got[1].said == "".join(f"t{k} <" for k in range(0, 5000, 2)) and len(got[1].loss) == 2500
    assert [tuple(t) for t in got[2].back] == [("", ""), ("assistant", "b"), ("user", "a"), ("user", "a"), ("user", "a"), ("assistant", "")]
    assert all(len(t.columns) == 6 for t in chat_format.ascents(nodes))  # a row is as wide however long the thread


# --- 6 ---


def brute_base(text):
    words = WORD.findall(text or "")
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(three).items() if n > 1}
    repeated = {i + k for i, w in enumerate(three) if w in often for k in range(3)}
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), failed


def test_quality_rules(spark, medium, table):
    got = by_id(queries.op6_quality_rules(spark, medium))
    for d in table(medium, "documents"):
        r = got[d["doc_id"]]
        assert tuple(r)[1:7] == brute_base(d["text"])
        assert not (r.base_failed and r.kept)
    labels = {x["doc_id"]: x for x in table(medium, "labels")}
    good = [got[i] for i, x in labels.items() if x["quality"] == 1 and not got[i].base_failed]
    bad = [got[i] for i, x in labels.items() if x["quality"] == 0 and not got[i].base_failed]
    assert np.mean([r.kept for r in good]) > 0.98
    assert np.mean([r.score for r in good]) > np.mean([r.score for r in bad])


def test_quality_on_labels_not_used_for_the_fit(spark, medium, table):
    docs, labels = (spark.read.parquet(f"{medium}/{n}.parquet") for n in ("documents", "labels"))
    unused = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    m = queries.train_quality(docs, labels.where(~unused))
    got = by_id(quality.judge(docs.join(labels.where(unused).select("doc_id"), "doc_id", "left_semi"), m.ratios, threshold=m.threshold, toxic=m.toxic, toxic_threshold=m.toxic_threshold).where("not base_failed"))
    of = {k: [got[x["doc_id"]] for x in table(medium, "labels") if x["doc_id"] in got and (x["quality"], x["toxic"]) == k] for k in [(1, 0), (0, 0), (1, 1)]}
    assert np.mean([r.quality_kept for r in of[1, 0]]) > 0.95 and np.mean([r.quality_kept for r in of[0, 0]]) < 0.1
    # about 0.37 of the documents labelled toxic, none of them English, have no word that tells them from clean ones
    english = [r for r in of[1, 1] if r.lang == "en"]
    assert english and np.mean([r.quality_toxic for r in english]) > 0.7 and np.mean([r.quality_toxic for r in of[1, 0]]) < 0.06


def test_quality_scores_equal_plain_counts(spark, small, table):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    counts = quality.bucket_counts(docs)
    plain = np.zeros(quality.BUCKETS)
    for d in table(small, "documents"):
        np.add.at(plain, quality.ngram_buckets((d["text"] or "").encode()), 1)
    assert (counts == plain).all()


def test_quality_verdicts_equal_plain_sums(spark, small, table):
    """score and kept recomputed text by text: n-grams hashed one by one, ratios from plain counts, the threshold as a sorted list's place."""
    docs = {d["doc_id"]: d["text"] or "" for d in table(small, "documents")}
    labels = table(small, "labels")
    token = re.compile(r"[a-z0-9\x80-\U0010ffff]+|[^a-z0-9\x80-\U0010ffff\x20\x09-\x0d]+")

    def grams(text):
        h = quality.word_hashes([w.encode() for w in token.findall(lower(text))])
        one, two = quality.mixed(h), quality.windows(h, 2)
        return [int(x) % quality.BUCKETS for x in [*one.tolist(), *two.tolist()]]

    own = {i: grams(t) for i, t in docs.items()}
    clean = [x["doc_id"] for x in labels if x["quality"] == 1 and x["toxic"] == 0 and x["doc_id"] in docs]
    raw, target = (Counter(g for i in ids for g in own[i]) for ids in (docs, [i for i in clean if crc(i, 4) != 3]))
    a, b = sum(target.values()) + quality.SMOOTHING * quality.BUCKETS, sum(raw.values()) + quality.SMOOTHING * quality.BUCKETS
    ratio = lambda g: math.log((target[g] + quality.SMOOTHING) / a) - math.log((raw[g] + quality.SMOOTHING) / b)
    score = {i: sum(map(ratio, g)) / len(g) if g else 0.0 for i, g in own.items()}
    fit = sorted(score[i] for i in clean if crc(i, 4) == 3 and not brute_base(docs[i])[-1])
    threshold = fit[int((1 - quality.KEEP_CLEAN) * (len(fit) - 1))]
    got = by_id(queries.op6_quality_rules(spark, small))
    for i, want in score.items():
        assert got[i].score == pytest.approx(want, abs=2e-6)
        if abs(want - threshold) > 1e-5:
            assert got[i].kept == (not brute_base(docs[i])[-1] and want > threshold)


def test_quality_learns_from_all_labelled(spark):
    n = 4300  # of each class; a bounded sample had 4,000
    r = np.random.default_rng(3)
    kinds = ("trusted", "toxic", "clean", "other")
    texts = [" ".join(f"{'ab'[k == 1]}{w}" for w in r.zipf(1.3, 52) % 3000) for k in range(4) for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string").repartition(4)
    ids = [spark.range(k * n, (k + 1) * n).withColumnRenamed("id", "doc_id") for k in range(3)]
    m = quality.fit(docs, ids[0].union(ids[0]).union(spark.sql("select cast(null as long)")), ids[1], ids[2])
    grams = {k: [quality.ngram_buckets(t.encode()) for t in texts[i * n : (i + 1) * n]] for i, k in enumerate(kinds)}
    count = lambda g, once=False: np.bincount(np.concatenate([np.unique(x) if once else x for x in g]), minlength=quality.BUCKETS).astype(float)
    ratios = quality.log_ratios(count(grams["trusted"]), sum(count(g) for g in grams.values()))
    weights = quality.toxic_weights(count(grams["toxic"], True), n, count(grams["trusted"], True), n)
    assert (m.ratios == ratios).all() and (m.toxic == weights).all() and weights.any()
    ok = [g for g, t in zip(grams["clean"], texts[2 * n :]) if not brute_base(t)[-1]]
    assert len(ok) > 4000
    assert m.threshold == np.quantile([quality.mean_weight(g, ratios) for g in ok], 1 - quality.KEEP_CLEAN, method="lower")
    assert m.toxic_threshold == np.quantile([quality.mean_weight(g, weights) for g in ok], quality.KEEP_CLEAN, method="higher")


def test_order_statistics(spark):
    rows = [(x, -x) for x in [*np.random.default_rng(1).normal(size=300).tolist(), 0.0, -0.0, 1e300, -1e300, 5e-324, 2.5, 2.5, 2.5]]
    df = spark.createDataFrame(rows, "a double, b double")
    for place in (0, 1, 150, 151, 152, 153, 300, 306, 307):
        assert quality.order_statistics(df, {"a": lambda n: place, "b": lambda n: n - 1 - place}) == {"a": sorted(x for x, _ in rows)[place], "b": -sorted(x for x, _ in rows)[place]}
    assert quality.order_statistics(df.limit(0), {"a": lambda n: 0}) == {}


def test_quality_odd_rows(odd, empty):
    got = quality.judge(odd, np.zeros(quality.BUCKETS, np.float32)).collect()
    assert len(got) == odd.count() and all(tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_base(r.text) for r in got)
    assert quality.bucket_counts(empty).sum() == 0
    assert not quality.log_ratios(np.zeros(quality.BUCKETS), np.ones(quality.BUCKETS)).any()


# --- 7 ---


def brute_mix(rows, limit=mixing.MAX_REPETITION):
    tokens = [(i, s, t, len(WORD.findall(t or ""))) for i, s, t in rows]
    per = Counter()
    for _, s, _, n in tokens:
        per[s] += n
    per = {s: n for s, n in per.items() if n}
    total = sum(per.values())

    def weights(a):
        p = {s: (n / total) ** a for s, n in per.items()}
        return {s: x / sum(p.values()) for s, x in p.items()}

    low, high = 0.0, 1.0
    for _ in range(36):
        mid = (low + high) / 2
        if all(w * total <= limit * per[s] for s, w in weights(mid).items()):
            high = mid
        else:
            low = mid
    out = Counter()
    for s, w in weights(high).items():
        left, block = round(w * total), 0
        while left > 0:
            def place(r, block=block):
                md = hashlib.md5((r[2] or "").encode()).hexdigest()
                return int(hashlib.md5(f"0:{block}:{'' if r[0] is None else r[0]}:{md}".encode()).hexdigest()[:12], 16)

            last, cut = left <= per[s], None
            for r in sorted((r for r in tokens if r[1] == s), key=place):
                if last and left <= 0 and place(r) != cut:
                    break
                out[r[0], s, block] += 1
                left -= r[3]
                cut = place(r)
            block += 1
            if last:
                break
    return out


@pytest.mark.parametrize("ranges", [mixing.BUCKET_ROWS, 7])
def test_mixing_equals_brute_force(spark, medium, table, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", ranges)
    got = mixing.mix(spark.read.parquet(f"{medium}/documents.parquet")).collect()
    assert Counter((r.doc_id, r.source, r.mix_block) for r in got) == brute_mix([(d["doc_id"], d["source"], d["text"]) for d in table(medium, "documents")])
    assert all(0 <= r.mix_order <= 1 for r in got)


def test_mixing_targets(spark):
    shares = spark.createDataFrame([("a", 1, 900, 0.9), ("b", 1, 100, 0.1)], "source string, docs long, tokens long, share double")
    a = mixing.find_exponent(shares, target_entropy=0.6)
    p = 0.9**a / (0.9**a + 0.1**a)
    assert abs(-p * math.log(p) - (1 - p) * math.log(1 - p) - 0.6) < 1e-6
    assert mixing.find_exponent(shares, target_entropy=9.0) == 0.0
    assert mixing.find_exponent(shares, max_repetition=1.0) == 1.0
    assert mixing.find_exponent(shares, max_repetition=100.0) < 1e-9


def test_mixing_odd_rows(odd, empty):
    got = mixing.mix(odd).collect()
    assert 2 in {r.doc_id for r in got if r.source is None}
    assert Counter((r.doc_id, r.source, r.mix_block) for r in got) == brute_mix([(r.doc_id, r.source, r.text) for r in odd.collect()])
    assert mixing.mix(empty).count() == 0
    assert "n_words" in mixing.mix(odd).columns


# --- 8 ---


def brute_lm(rows, discount=lm_score.DISCOUNT, alpha=lm_score.ALPHA):
    toks = lambda t: WORD.findall(lower(t)) + [""]
    c, arcs = Counter(), defaultdict(Counter)
    for _, t, train in rows:
        if train:
            w = toks(t)
            c.update(w)
            for order in (1, 2):
                for k in range(len(w) - order):
                    arcs[tuple(w[k : k + order])][w[k + order]] += 1
    n, v = sum(c.values()), len(c)

    def prob(h, w):
        if not h:
            return (c[w] + alpha) / (n + alpha * (v + 1))
        if h not in arcs:
            return prob(h[1:], w)
        own, total = arcs[h], sum(arcs[h].values())
        return max(0, own.get(w, 0) - discount) / total + discount * len(own) / total * prob(h[1:], w)

    out = {}
    for i, t, _ in rows:
        w = toks(t)
        out[i] = (len(w), sum(x in c for x in w), n, sum(math.log10(prob((), x)) for x in w), sum(math.log10(prob(tuple(w[max(0, k - 2) : k]), x)) for k, x in enumerate(w)))
    # proper in every state: known words and one unknown sum to 1
    for h in [(), *list(arcs)[:5]]:
        assert abs(sum(prob(h, w) for w in list(c)) + prob(h, object()) - 1) < 1e-9
    return out


@pytest.mark.parametrize("size", ["small", "medium"])
def test_lm_score_equals_brute_force(spark, size, table, request):
    folder = request.getfixturevalue(size)
    want = brute_lm([(d["doc_id"], d["text"], crc(d["doc_id"], 10) != 0) for d in table(folder, "documents")])
    got = by_id(queries.op8_lm_score(spark, folder))
    assert set(got) == set(want)
    for i, w in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3] and r.held_out == (crc(i, 10) == 0)
        assert r.base_score == pytest.approx(w[3], rel=1e-9) and r.score == pytest.approx(w[4], rel=1e-9)


@pytest.mark.parametrize("hot", [1, 20, 1000])
def test_lm_score_in_many_blocks_and_parts(spark, small, table, monkeypatch, hot):
    monkeypatch.setattr(lm_score, "LANE", 37)
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 3000)
    monkeypatch.setattr(lm_score, "PART_ENTRIES", 2500)
    monkeypatch.setattr(lm_score, "HOT", hot)
    rows = [(d["doc_id"], d["text"], crc(d["doc_id"], 10) != 0) for d in table(small, "documents")]
    rows += [(10_000 + i, "the " * (i + 1) + f"the w{i} the", i % 3 > 0) for i in range(300)]
    want = brute_lm(rows)
    got = by_id(lm_score.score(spark.createDataFrame(rows, "doc_id long, text string, t boolean").repartition(5), F.col("t")))
    assert all((got[i].n_tokens, got[i].n_known, got[i].train_tokens) == w[:3] for i, w in want.items())
    assert all(got[i].base_score == pytest.approx(w[3], rel=1e-9) and got[i].score == pytest.approx(w[4], rel=1e-9) for i, w in want.items())


def test_lm_score_falls_through_two_failure_arcs(spark):
    rows = [(i, "a b c d", True) for i in range(3)] + [(4, "x a b e", True), (5, "b f", True), (10, "a b f", False), (11, "a b x", False)]
    got = by_id(lm_score.score(spark.createDataFrame(rows, "doc_id long, text string, t boolean"), F.col("t")))
    d, alpha, n, v = lm_score.DISCOUNT, lm_score.ALPHA, 23, 8
    root = lambda count: (count + alpha) / (n + alpha * (v + 1))
    begin = root(4) * ((4 - d) / 4 + d / 4 * root(5))  # "a b"
    # "a b" was followed by c and e, "b" by c, e and f: f is one failure arc away, x two
    one = begin * (d * 2 / 4) * ((1 - d) / 5 + d * 3 / 5 * root(1))
    two = begin * (d * 2 / 4) * (d * 3 / 5) * root(1)
    # the end: "b f" is a state and has it, "b x" is none, and "x" hasn't
    assert got[10].score == pytest.approx(math.log10(one * (1 - d + d * (1 - d + d * root(5)))), rel=1e-12)
    assert got[11].score == pytest.approx(math.log10(two * d * root(5)), rel=1e-12)


def test_lm_score_counts_rare_pairs_at_any_size(spark):
    rows = [(i, " ".join(f"f{k % 500}" for k in range(1500)), True) for i in range(140)] + [(140 + i, "a rare pair of words f1", True) for i in range(2)] + [(200, "a rare pair of f1", False)]
    want = brute_lm(rows)
    got = by_id(lm_score.score(spark.createDataFrame(rows, "doc_id long, text string, t boolean"), F.col("t")))
    assert got[200].train_tokens > 200_000
    assert all(got[i].score == pytest.approx(w[4], rel=1e-9) for i, w in want.items())


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [1, 255, 256, 1 << 40], [(1 << 64) - 1, 0]])
def test_lm_score_packed_numbers(values):
    assert lm_score.unpacked(lm_score.packed(np.array(values, np.uint64))).tolist() == values
    assert lm_score.unpacked_names(lm_score.packed_names(np.sort(np.array(values, np.uint64)))).tolist() == sorted(values)


SHINGLES_OF_A_MILLION_WORDS = """
import resource
from plaza.llm import jaccard_join
raw = b" ".join(b"%d" % i for i in range(1_000_000))
hashes = jaccard_join.word_hashes(raw.split())
jaccard_join.windows(hashes, 5)
jaccard_join.word_hashes = lambda words: hashes
most = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
before = most()
jaccard_join.shingles_of(raw)
print((most() - before) // 1024)
"""


def test_jaccard_shingles_take_little_memory_beside_the_words():
    out = subprocess.run([sys.executable, "-c", SHINGLES_OF_A_MILLION_WORDS], capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": str(Path(jaccard_join.__file__).parents[2])})
    assert int(out.stdout) < 12  # MB; 24 when they were hashed


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_distinct_values(n):
    values = np.random.default_rng(n).integers(0, 1 << 64, n, np.uint64)[np.arange(2 * n) % max(n, 1)]
    assert common.distinct(values).tolist() == sorted(set(values.tolist()))


def test_lm_score_walk_takes_little_memory_a_token():
    rng = np.random.default_rng(7)
    numbers, train = lm_score.Numbers(), [i % 10 != 0 for i in range(600)]
    docs = [np.array([numbers[b"%d" % x] for x in rng.zipf(1.3, 500).clip(max=20000) % 5000] + [numbers[lm_score.END]]) for _ in train]
    row = lm_score._block(0, list(range(600)), train, numbers, docs, pa.int64()).to_pylist()[0]
    hot = lm_score.Hot(np.empty(0, np.uint64), np.empty((0, 2), np.int64), np.array([2]))
    asked = defaultdict(list)
    for own in lm_score._requests(row, 2, hot):
        asked[own[0]].append(own)
    kinds = dict.fromkeys(("part", "block"), pa.int64()) | dict.fromkeys(lm_score._PACKED, pa.binary())
    answers = [r for rows in asked.values() for r in lm_score._added(pa.table({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), zip(*rows))}), -1, False).to_pylist()]
    words = len(lm_score.unpacked_names(row["words"]))
    block = {"lengths": row["lengths"], "tokens": row["tokens"], "words": words, "hot": []}
    tracemalloc.start()
    out = lm_score._walk(block, answers, 2, hot, np.empty(0), sum(a["v"] for a in answers), sum(a["n"] for a in answers), 0.1, 0.75)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[0].sum() == row["size"] and peak < 44 * (row["size"] + row["entries"] - words)


def test_lm_score_odd_rows(odd, empty):
    got = lm_score.score(odd, F.lit(True)).collect()
    assert len(got) == odd.count() and all(r.n_tokens == 1 for r in got if r.doc_id in (3, 4, 5))
    nothing = lm_score.score(odd, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in nothing)
    assert lm_score.score(empty, F.lit(True)).count() == 0


# --- 9 ---


def brute_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ("email", "ip", "card", "phone").index(s[0])))


def test_pii_base_spans_equal_the_rules(spark, medium, table):
    got = by_id(queries.op9_pii(spark, medium))
    added = 0
    for d in table(medium, "documents"):
        want = brute_spans(d["text"] or "")
        r = got[d["doc_id"]]
        written = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == sha(",".join(written))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.BASE]
        assert set(written) <= set(r.spans.split(",")) | {""}
        added += len([s for s in r.spans.split(",") if s]) - len(want)
    secrets = sum(bool(re.search(r'token = "[0-9a-fA-F]{40}"', d["text"] or "", re.I)) for d in table(medium, "documents"))
    assert added >= secrets > 0


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e x@y z.@q.r-", "@a.b a@.b a@b..c", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1.2.3.400", "4111 1111 1111 1111 4111-1111-1111-1112 5  6 4111111111111111-", "+1 (234) 567-8901. +12 +123456789 +1234567890123456 ++49 30 1234567", "a" * 3000 + "@", "9" * 5000, "+" * 2000 + "1-" * 500, "a.b" * 500 + "@x.y" * 300],
)
def test_pii_base_spans_of_hard_texts(text):
    assert pii.base_spans(text) == brute_spans(text)
    assert [s[:3] for s in pii.candidates(text) if s[3]] == brute_spans(text)


def test_pii_added_spans_equal_a_plain_fit(spark, small, table):
    """All spans recomputed: votes of each candidate, EM candidate by candidate, and the classifier from the labelled candidates."""
    docs = {d["doc_id"]: d["text"] or "" for d in table(small, "documents")}
    found = {i: pii.candidates(t) for i, t in docs.items()}
    votes = [pii.pattern(docs[i], k, a, b) for i, spans in found.items() for k, a, b, _ in spans]
    soft = {}
    for kind in pii.KINDS:
        own = [v for v in votes if v[0] == kind]
        theta, prior = pii.START.copy(), 0.5
        pseudo = pii.START * max(1.0, 0.05 * len(own))
        for _ in range(pii.ROUNDS if own else 0):
            belief = []
            for v in own:
                no, yes = 1 - prior, prior
                for j, x in enumerate(v[1 : 1 + pii.LABELERS]):
                    no, yes = no * theta[j, 0, x + 1], yes * theta[j, 1, x + 1]
                belief.append(yes / (no + yes))
            prior = (sum(belief) + 1) / (len(own) + 2)
            theta = pseudo.copy()
            for v, p in zip(own, belief):
                for j, x in enumerate(v[1 : 1 + pii.LABELERS]):
                    theta[j, 0, x + 1] += 1 - p
                    theta[j, 1, x + 1] += p
            theta /= theta.sum(2, keepdims=True)
        soft.update(zip(own, belief if own else ()))
    model = pii.Model({}, pii.train_classifier(Counter(votes), soft))
    got = by_id(queries.op9_pii(spark, small))
    for i, spans in found.items():
        sure = [(k, a, b) for k, a, b, base in spans if base or abs(model.probability(pii.pattern(docs[i], k, a, b)) - pii.ACCEPT) > 1e-4 and model.probability(pii.pattern(docs[i], k, a, b)) > pii.ACCEPT]
        assert got[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in sure)


@pytest.mark.parametrize("length", [20, 512, 513, 4096])
def test_pii_secrets_of_any_length(length):
    key = "".join(hashlib.sha512(str(i).encode()).hexdigest() for i in range(length // 128 + 1))[:length]
    assert ("secret", 7, 7 + length, False) in pii.candidates(f"token: {key} end")


def test_pii_learns_reliabilities_and_masks(spark, odd, empty):
    rows = [(i, f"call me +49 30 12345{i:03d} or mail u{i}@x.com, token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\"") for i in range(200)] + [(1000 + i, f"commit {hashlib.sha1(str(i).encode()).hexdigest()} page 123456789") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = pii.pattern_counts(docs)
    tables, posterior = pii.reliabilities(counts)
    assert tables["secret"][3, 1, 2] > tables["secret"][3, 0, 2]  # the context labeler votes yes on true secrets
    assert all(0 <= p <= 1 for p in posterior.values())
    masked = by_id(pii.mask(docs, pii.train(docs)))
    assert masked[5].text == 'call me <phone> or mail <email>, token = "<secret>"'
    assert masked[1000].text == rows[200][1]
    model = pii.train(odd)
    assert pii.find(odd, model).count() == odd.count()
    assert [r.text for r in pii.mask(odd, model).collect() if r.doc_id == 3] == [None]
    assert pii.find(empty, pii.train(empty)).count() == 0


# --- 10 ---


def brute_hits(docs, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t))
        k = min(window, len(w))
        for a in range(len(w) - k + 1) if k else ():
            wins[tuple(w[a : a + k])].add(str(i))
    sizes = {len(w) for w in wins}
    out = {}
    for i, t in docs:
        w = word.findall(lower(t))
        hit, ids = set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if (x := tuple(w[a : a + k])) in wins:
                    hit.update(range(a, a + k))
                    ids |= wins[x]
        out[i] = (len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit))
    return out


def test_decontamination_equals_brute_force(spark, medium, table):
    want = brute_hits([(d["doc_id"], d["text"]) for d in table(medium, "documents")], [(d["item_id"], d["text"]) for d in table(medium, "benchmark")])
    got = by_id(queries.op10_decontaminate(spark, medium))
    assert {i: tuple(r)[1:] for i, r in got.items()} == want
    assert any(w[4] for w in want.values())


@pytest.mark.parametrize("local", [0, 5, 60])
def test_decontamination_with_more_windows_than_are_compared_in_the_scan(spark, small, table, local):
    want = brute_hits([(d["doc_id"], d["text"]) for d in table(small, "documents")], [(d["item_id"], d["text"]) for d in table(small, "benchmark")])
    docs, items = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "benchmark"))
    got = by_id(decontaminate.contamination(docs, items, local_windows=local))
    assert {i: (r.n_words, r.n_hit, r.n_items, sha(",".join(r["items"])), r.contaminated) for i, r in got.items()} == want


def test_decontamination_of_texts_that_share_an_id(spark):
    rows = [(1, "a b c x y"), (1, "a b q x y"), (1, "a b c x y"), (None, "q r"), (None, "b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, "b c")], "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit) for r in decontaminate.contamination(docs, items).collect())
    assert got == Counter([(1, 5, 2), (1, 5, 0), (None, 2, 0), (None, 2, 2)])
    assert sorted(r.text for r in decontaminate.without_contaminated(docs, items).collect()) == ["a b q x y", "q r"]


def test_decontamination_of_short_and_repeating_items(spark, odd, empty):
    items = [(1, "Fox jumps"), (2, "x x x x x x x x x x x x"), (3, None), (4, "..."), (5, "the quick brown fox jumps over the lazy dog near the river"), (6, "日本語"), (7, "Fox  jumps!"), (8, "end")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(odd, benchmark)
    want = brute_hits([(r.doc_id, r.text) for r in odd.collect() if r.doc_id], items)
    rows = got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated").collect()
    assert {r[0]: tuple(r)[1:] for r in rows if r[0]} == want
    assert sum(r[0] is None for r in rows) == 2
    assert not any(r.contaminated for r in decontaminate.contamination(odd, benchmark.limit(0)).collect())
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert sorted(r.doc_id or 0 for r in decontaminate.without_contaminated(odd, benchmark).collect()) == [0, 3, 4, 5, 7, 8, 10]

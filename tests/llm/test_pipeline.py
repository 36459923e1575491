"""The pipeline's stages, one after the other, against brute force, and on odd rows."""

from collections import Counter

import corpus_pipeline
import pytest
import zstandard
from plaza.llm import language_id, pii, queries

from .test_operators import brute_hits, brute_links, brute_mix, brute_sets

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """name -> the rows that a stage read and the rows that it returned, over the smallest tables."""
    folder = f"{queries_folder()}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stages')}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs.collect(), after.collect(), docs)
        docs = after
    return out


def queries_folder():
    from .conftest import DATA

    return DATA


def brute_language(text, dictionaries):
    """The language of the fewest bytes, the share by which the next one needs more, by plain one-shot compression."""
    folded = language_id.folded((text or "").encode())
    if not any(map(str.isalpha, text or "")):
        return None, 0.0
    pieces = [folded[a : a + language_id.BLOCK] for a in range(0, len(folded), language_id.BLOCK)]
    if len(folded) <= language_id.SHORT:
        words = folded.split()
        pieces = [b" ".join(words[a:] + words[:a]) for a in range(0, len(words), max(1, len(words) // language_id.ROTATIONS))]
    sizes = []
    for name, content in dictionaries:
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(language_id.LEVEL, dict_size=len(content), source_size=language_id.BLOCK, min_match=language_id.MIN_MATCH, write_checksum=False, write_content_size=False, write_dict_id=False)
        own.precompute_compress(compression_params=params)
        sizes.append(sum(len(zstandard.ZstdCompressor(compression_params=params, dict_data=own).compress(p)) for p in pieces))
    order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
    return dictionaries[order[0]][0], (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]]


def test_language_stage(runs):
    before, after, docs = runs["language_id"]
    dictionaries = queries.train_languages(docs)
    want = {}
    for r in before:
        lang, margin = brute_language(r.text, dictionaries)
        if lang and margin >= language_id.MIN_MARGIN:
            want[r.doc_id] = (r.text, lang, r.source, r.n_chars)
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in after} == want
    assert len(after) == len(want) > 0.9 * len(before)


def test_near_duplicate_stage(runs):
    before, after, _ = runs["jaccard_join"]
    _, component = brute_links(brute_sets([(r.doc_id, r.text) for r in before]))
    assert sorted(r.doc_id for r in after) == sorted(set(component.values()))
    rows = {r.doc_id: tuple(r) for r in before}
    assert all(rows[r.doc_id] == tuple(r) for r in after) and len(after) < len(before)


def test_decontamination_stage(runs, small, table):
    before, after, _ = runs["decontaminate"]
    hits = brute_hits([(r.doc_id, r.text) for r in before], [(d["item_id"], d["text"]) for d in table(small, "benchmark")])
    assert sorted(tuple(r) for r in after) == sorted(tuple(r) for r in before if not hits[r.doc_id][4])


def test_masking_stage(runs):
    before, after, docs = runs["pii"]
    model = pii.train(docs)
    assert len(before) == len(after)
    texts, masked = {r.doc_id: r for r in before}, 0
    for r in after:
        want, text = [], texts[r.doc_id].text
        done = 0
        for kind, a, b in sorted(model.spans(text)[1], key=lambda s: (s[1], -s[2], s[0])):
            if a >= done:
                want += [text[done:a], f"<{kind}>"]
                done = b
        want = "".join([*want, text[done:]])
        assert (r.text, r.n_chars, r.lang, r.source) == (want, len(want), texts[r.doc_id].lang, texts[r.doc_id].source)
        assert not pii.base_spans(r.text)
        masked += want != text
    assert masked


def test_mixing_stage_keeps_the_masked_texts(runs):
    before, after, _ = runs["mixing"]
    assert Counter((r.doc_id, r.source, r.mix_block) for r in after) == brute_mix([(r.doc_id, r.source, r.text) for r in before])
    rows = {r.doc_id: tuple(r) for r in before}
    assert all(tuple(r)[:5] == rows[r.doc_id] for r in after)


def test_run_is_the_stages_in_order(spark, runs, small):
    got = corpus_pipeline.run(spark, small)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, runs["mixing"][1]))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontaminate", "pii", "mixing"]


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_on_odd_and_empty_rows(spark, odd, empty, small, name):
    rows = odd.select("doc_id", "text", "lang", "source", "n_chars", "n_words", "score")
    got = STAGES[name](spark, rows, small)
    assert got.columns[: len(rows.columns)] == rows.columns
    kept = got.collect()
    texts = Counter((r.doc_id, r.text) for r in kept)
    both = Counter((r.doc_id, r.text) for r in rows.collect())
    assert STAGES[name](spark, empty, small).count() == 0
    if name == "jaccard_join":
        assert both - texts == Counter({(2, rows.where("doc_id = 2").first().text): 1}) and not texts - both
    if name == "decontaminate":
        assert texts == both
    if name == "pii":
        assert sum(texts.values()) == sum(both.values()) and (3, None) in texts
    if name == "mixing":
        assert set(texts) <= set(both)

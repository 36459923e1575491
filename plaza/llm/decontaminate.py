"""Benchmark decontamination by a prefix-filtered join of shingles.

A document word is hit if it lies in an occurrence of a benchmark window (``window``
consecutive item words; a shorter item is one window). A window is the set of its
``SHINGLE``-word shingles; containment must be whole, so the necessary prefix of a window
in rarity order is one shingle: its rarest, by occurrences over all documents. Documents
are joined on that shingle alone, the shingle's offset bounds the one position where the
window can stand, and the words there are compared with the window's.

Documents never leave their scan but for the few positions that pass a bit filter of
fixed size; the comparison decides, so the filter changes no result. The windows whose
prefixes are most frequent, ``LOCAL_WINDOWS`` at most, are broadcast and compared in the
scan, so no frequent prefix is a key of a shuffle; if there are more windows, the places
that pass are joined with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import longs, raw_texts, slices, stored, windows, without_rows, word_hashes

WINDOW = 10
SHINGLE = 3
#: Windows that are compared where the documents lie, those with the most frequent prefixes; places of all others are shuffled to them.
LOCAL_WINDOWS = 100_000
#: Slots of the bit filter, whatever the benchmark's size.
FILTER_SLOTS = 1 << 22

#: Lower-cases A-Z and turns every other ASCII character but letters and digits to a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id string, length, words, shingles array of (hash, offset)) of each distinct window of each item; null or wordless items have none."""
    names = ["item_id", "length", "words", "shingles"]
    schema = "item_id string, length int, words string, shingles array<struct<shingle: long, at: int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out: dict[str, list] = {n: [] for n in names}
            for key, raw in zip(part.column(0).to_pylist(), raw_texts(part.column(1))):
                words = words_of(raw)
                size = min(window, len(words))
                for run_ in {tuple(words[at : at + size]) for at in range(len(words) - size + 1)} if size else ():
                    hashes = windows(word_hashes(list(run_)), min(SHINGLE, size)).view(np.int64).tolist()
                    out["item_id"].append(key)
                    out["length"].append(size)
                    out["words"].append(b" ".join(run_).decode("utf-8", "replace"))
                    out["shingles"].append([{"shingle": h, "at": at} for at, h in enumerate(hashes)])
            kinds = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(names, kinds)], names=names)

    return items.select(F.col(item).cast("string").alias("item_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _filter(spark, shingles: DataFrame):
    """A broadcast bit filter of FILTER_SLOTS slots."""
    taken = np.zeros(FILTER_SLOTS, bool)
    slots = shingles.select(F.col("shingle").bitwiseAND(FILTER_SLOTS - 1).alias("slot")).distinct().toArrow()  # at most FILTER_SLOTS
    taken[slots.column(0).to_numpy()] = True
    return spark.sparkContext.broadcast(np.packbits(taken))


def _passing(words: list[bytes], taken: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the text's shingles that pass the filter."""
    h = word_hashes(words)
    ats, got = [], []
    for size in sizes:
        s = windows(h, size)
        at = np.flatnonzero(taken[s & np.uint64(FILTER_SLOTS - 1)])
        ats.append(at)
        got.append(s[at])
    return np.concatenate(ats), np.concatenate(got)


def shingle_counts(docs: DataFrame, shingles: DataFrame, sizes: tuple[int, ...], text: str = "text") -> DataFrame:
    """How often each benchmark shingle occurs in all documents: (shingle, n); absent ones are missing."""
    bits = _filter(docs.sparkSession, shingles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = np.unpackbits(bits.value).view(bool)
        for part in slices(batches):
            found = [_passing(words_of(raw), taken, sizes)[1] for raw in raw_texts(part.column(0))]
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([longs(keys), pa.array(n, pa.int64())], names=["shingle", "n"])

    counts = docs.select(text).mapInArrow(run, "shingle long, n long")
    return counts.groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixes(docs: DataFrame, items: DataFrame, text: str, item: str, item_text: str, window: int) -> tuple[DataFrame, tuple[int, ...]]:
    """(item_id, length, words, shingle, at, n) of each window, by its rarest shingle, which n places in the documents have; and the sizes of the shingles."""
    spans = stored(benchmark_windows(items, item, item_text, window), "windows")
    each = spans.select("item_id", "length", "words", F.explode("shingles").alias("s")).select("item_id", "length", "words", "s.*")
    sizes = tuple(r[0] for r in spans.select(F.least("length", F.lit(SHINGLE)).alias("size")).distinct().orderBy("size").collect()) or (SHINGLE,)
    counts = shingle_counts(docs, each, sizes, text)
    rare = (
        each.join(counts, "shingle", "left")
        .groupBy("item_id", "length", "words")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at")).alias("p"))
        .select("item_id", "length", "words", "p.shingle", "p.at", "p.n")
    )
    return stored(rare, "prefix"), sizes


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges, as ranges in order that don't touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = "array<struct<start: int, end: int>>"
_FOUND = pa.list_(pa.struct([("shingle", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()), ("near", pa.list_(pa.string()))]))


def contamination(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, local_windows: int = LOCAL_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items array<string> sorted, contaminated, text_key), one row for each document.

    Rows that repeat both id and text are one document; rows that share an id (or a null one)
    but not the text are documents of their own, told apart by text_key, xxhash64 of the text.
    Null texts have no words, an empty benchmark hits nothing, empty documents give no rows.
    Other columns aren't read.
    """
    spark = docs.sparkSession
    prefix, sizes = prefixes(docs, items, text, item, item_text, window)
    bits = _filter(spark, prefix)
    local = prefix.orderBy(F.desc("n"), "shingle").limit(local_windows + 1).collect()
    least = local[-1].n if len(local) > local_windows else -1  # windows of more frequent prefixes are compared in the scan, the rest are joined
    table: dict[int, list[tuple[int, tuple[bytes, ...], str]]] = {}
    for r in local:
        if r.n > least:
            table.setdefault(r.shingle, []).append((r.at, tuple(r.words.encode().split(b" ")), r.item_id))
    known = spark.sparkContext.broadcast(table)
    around = window - 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken, own = np.unpackbits(bits.value).view(bool), known.value
        for part in slices(batches):
            n, spans, found_items, found = [], [], [], []
            for raw in raw_texts(part.column(2)):
                words = words_of(raw)
                ats, got = _passing(words, taken, sizes)
                here, names, rows = [], set(), []
                for at, h in zip(ats.tolist(), got.view(np.int64).tolist()):
                    for back, run_, name in own.get(h, ()):
                        start = at - back
                        if start >= 0 and tuple(words[start : start + len(run_)]) == run_:  # the one place where it can stand
                            here.append((start, start + len(run_)))
                            names.add(name)
                    if least >= 0 and h not in own:
                        first = max(0, at - around)
                        rows.append({"shingle": h, "pos": at, "first": first, "near": [w.decode("utf-8", "replace") for w in words[first : at + window]]})
                n.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(here)])
                found_items.append(sorted(names))
                found.append(rows)
            kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string()), _FOUND]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(x, k) for x, k in zip((n, spans, found_items, found), kinds))], names=["doc_id", "text_key", "n_words", "spans", "items", "found"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc].dataType), *T.StructType.fromDDL(f"text_key long, n_words long, spans {_SPANS}, items array<string>, found array<struct<shingle: long, pos: int, first: int, near: array<string>>>").fields])
    seen = docs.select(F.col(doc).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")).mapInArrow(scan, schema)
    by = ["doc_id", "text_key", "n_words"]
    parts = seen.select(*by, "spans", "items")
    if least >= 0:
        start = F.col("pos") - F.col("at")
        whole = (start >= 0) & (start + F.col("length") <= F.col("n_words"))  # positional and length bounds
        same = F.array_join(F.slice("near", F.greatest(start - F.col("first") + 1, F.lit(1)), F.col("length")), " ") == F.col("words")
        joined = seen.select(*by, F.explode("found").alias("f")).select(*by, "f.*").join(prefix.where(F.col("n") <= least).drop("n"), "shingle").where(whole & same)
        parts = parts.unionByName(joined.select(*by, F.array(F.struct(start.cast("int").alias("start"), (start + F.col("length")).cast("int").alias("end"))).alias("spans"), F.array("item_id").alias("items")))
    # repeated rows send equal lists, which count once
    grouped = parts.groupBy(*by).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["upto"]))).alias("n"), F.greatest(s["upto"], x["end"]).alias("upto")),
        lambda s: s["n"].cast("long"),
    )
    return grouped.select("doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", (F.size("items") > 0).alias("contaminated"), "text_key")


def without_contaminated(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of docs whose text isn't contaminated; clean texts stay, whatever other rows have the same id or a null one."""
    bad = contamination(docs, items, doc, text, **names).where("contaminated").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    return without_rows(docs, stored(bad, "contaminated"), doc, text)

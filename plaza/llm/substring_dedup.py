"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of a text. A word's end is a cut if the hash there is above
that of the ``REACH`` word ends before and not below that of the ``REACH`` after it, so cuts
depend on the text near them alone and come again after an insertion; chunks are ``REACH`` + 1
words long at least and about twice as many on average. Chunks are deduplicated by digest over
all documents, and within one: a chunk that occurs twice is repeated, and its first occurrence
(least document, then position) stays. A passage is a run of neighbouring repeated chunks of
``MIN_WORDS`` words or more.

Documents are chunked once, in blocks made where they are read; blocks ask for their distinct
digests by packed requests (``asking``), so a passage that all documents share costs a part one
entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .asking import answered, together
from .common import bounded_batches, mixed, packed, packed_names, raw_texts, slices, stored, tidy, unpacked

#: Word ends on both sides that a cut outdoes.
REACH = 3
#: Least words of a passage.
MIN_WORDS = 20
#: Bytes of text in a block, about.
BLOCK_BYTES = 16 << 20

#: The gear table, from a rule: the scrambled numbers 1 to 256.
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_INTEGERS = ("byte", "short", "integer", "long")
_SIGN = np.uint64(1 << 63)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash h = 4 h + GEAR[byte] (mod 2 ** 32) at each byte, which knows the last 16, by doubling the window four times."""
    h = GEAR[data]
    for back in (1, 2, 4, 8):
        h[back:] += h[:-back] << np.uint32(2 * back)
    return h


def chunks_of(raw: bytes, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """(starts, words): byte offset of each chunk, with the text's length at the end, and the number of the first word in each."""
    data = np.frombuffer(raw, np.uint8)
    ends = ~_SPACE[data]  # last byte of a word
    ends[:-1] &= _SPACE[data[1:]]
    at = np.flatnonzero(ends)
    if not len(at):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    h = gear_hashes(data)[at].astype(np.int64)
    around = np.lib.stride_tricks.sliding_window_view(np.pad(h, reach, constant_values=-1), 2 * reach + 1)
    cut = np.flatnonzero((h > around[:, :reach].max(1)) & (h >= around[:, reach + 1 :].max(1)))
    cut = cut[cut < len(at) - 1]
    return np.concatenate([[0], at[cut] + 1, [len(data)]]), np.concatenate([[0], cut + 1, [len(at)]])


def digests_of(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each chunk, without the space around it."""
    bounds_ = starts.tolist()
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b].strip()) for a, b in zip(bounds_, bounds_[1:])), np.uint64, len(bounds_) - 1)


def _block(name: int, ids: list, keys: list[int], digests: list[np.ndarray], words: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
    flat = np.concatenate(digests)
    row = np.repeat(np.array(keys, np.int64), [len(d) for d in digests])
    names, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
    key = row.view(np.uint64) ^ _SIGN  # in order as unsigned numbers
    least, most = np.full(len(names), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(names), np.uint64)
    np.minimum.at(least, inverse, key)
    np.maximum.at(most, inverse, key)
    # whether one row has it twice: neighbours in order of (name, row) are equal
    at = np.repeat(np.arange(len(digests)), [len(d) for d in digests])
    order = np.lexsort((at, inverse))
    twice = np.zeros(len(names), bool)
    twice[inverse[order[1:]][(np.diff(inverse[order]) == 0) & (np.diff(at[order]) == 0)]] = True
    data = [
        pa.array([name], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([keys], pa.list_(pa.int64())), pa.array([packed(np.array([len(d) for d in digests]))], pa.binary()),
        pa.array([packed(inverse)], pa.binary()), pa.array([packed(np.concatenate([np.diff(w) for w in words]))], pa.binary()), pa.array([packed_names(names)], pa.binary()),
        pa.array([packed(least)], pa.binary()), pa.array([packed(most - least << np.uint64(1) | twice)], pa.binary()), pa.array([len(names)], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(data, names=["block", "ids", "keys", "chunks", "place", "sizes", "names", "least", "spread", "entries"])


def chunked(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One row for each block of documents: their chunks, and the block's distinct digests with the least and greatest document that has each."""
    kind = docs.schema[doc].dataType
    key: Column = F.col(doc).cast("long") if kind.typeName() in _INTEGERS else F.xxhash64(F.col(doc))
    rows = docs.where(F.col(doc).isNotNull()).select(F.col(doc).alias("doc_id"), key.alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, ids, keys, digests, words = TaskContext.get().partitionId() << 32, 0, [], [], [], []
        id_type = None
        for part in slices(batches):
            id_type = part.column(0).type
            for own, number, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), raw_texts(part.column(2))):
                starts, upto = chunks_of(raw)
                if len(starts) > 1:
                    ids.append(own)
                    keys.append(number)
                    digests.append(digests_of(raw, starts))
                    words.append(upto)
                    size += len(raw)
                if size >= BLOCK_BYTES:
                    yield _block(name, ids, keys, digests, words, id_type)
                    name, size, ids, keys, digests, words = name + 1, 0, [], [], [], []
        if ids:
            yield _block(name, ids, keys, digests, words, id_type)

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), *T.StructType.fromDDL("keys array<long>, chunks binary, place binary, sizes binary, names binary, least binary, spread binary, entries long").fields])
    bounded_batches(docs.sparkSession)
    return rows.mapInArrow(run, schema)


def _seen(inverse: np.ndarray, n: int, told: list[np.ndarray]) -> np.ndarray:
    """Of each entry: 1 if its chunk is repeated, and 2 more if its block has the first document that holds it."""
    least, spread = told
    first, last, twice = np.full(n, np.iinfo(np.uint64).max, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
    np.minimum.at(first, inverse, least)
    np.maximum.at(last, inverse, least + (spread >> np.uint64(1)))
    twice[inverse[(spread & np.uint64(1)).astype(bool)]] = True
    return ((first < last) | twice)[inverse] + 2 * (least == first[inverse])


def _passages(marked: np.ndarray, edges: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Word ranges of runs of marked chunks that hold min_words; edges are the chunks' first words, with the end."""
    change = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    starts, ends = edges[change[::2]], edges[change[1::2]]
    ok = ends - starts >= min_words
    return list(zip(starts[ok].tolist(), ends[ok].tolist()))


def find_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, repeated_spans, repeated_words, removed_spans, removed_words) for each row with a repeated passage.

    Spans are ranges of words ([start, end), words being runs of characters other than ASCII
    white space). repeated: passages that occur elsewhere, in this document or another one.
    removed: passages of chunks that an earlier document, or an earlier place of this one, has
    already; they are what deduplication takes out. Documents are in order of an integer id, or
    of the hash of any other. Null, empty and short texts have no passages. Rows with a null id
    aren't looked at; rows that repeat an id are one document and aren't repeats of each other.
    Other columns aren't read. An empty table gives no rows.
    """
    blocks = stored(chunked(docs, doc, text), "chunks")
    answers = answered(blocks, ["least", "spread"], _seen)
    kind = T.ArrayType(T.StructType.fromDDL("start int, end int"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc].dataType)] + [T.StructField(f"{n}_{x}", t) for n in ("repeated", "removed") for x, t in (("spans", kind), ("words", T.LongType()))])

    def mark(_: tuple, block: pa.Table, answers_: pa.Table) -> pa.Table:
        flags = together(answers_).astype(np.uint8)
        ids = block["ids"].combine_chunks().flatten()
        keys = block["keys"].combine_chunks().flatten().to_numpy()
        counts, place, sizes, least = (unpacked(block[n][0].as_py()) for n in ("chunks", "place", "sizes", "least"))
        counts, place, sizes = counts.astype(np.int64), place.astype(np.int64), sizes.astype(np.int64)
        repeated = (flags[place] & 1).astype(bool)
        at = np.repeat(np.arange(len(counts)), counts)
        # the first place of a chunk in each row, and whether that row is the document where it stays
        order = np.lexsort((place, at))
        fresh = np.ones(len(place), bool)
        fresh[order[1:]] = (np.diff(place[order]) != 0) | (np.diff(at[order]) != 0)
        stays = fresh & ((flags[place] & 2) > 0) & (least[place] == (keys.view(np.uint64) ^ _SIGN)[at])
        out, done = [], 0
        for i, n in enumerate(counts.tolist()):
            own = slice(done, done + n)
            done += n
            if repeated[own].any():
                edges = np.concatenate([[0], np.cumsum(sizes[own])])
                if found := _passages(repeated[own], edges, min_words):
                    out.append((i, found, _passages(repeated[own] & ~stays[own], edges, min_words)))
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns = {"doc_id": ids.take(pa.array([o[0] for o in out], pa.int64()))}
        for k, n in ((1, "repeated"), (2, "removed")):
            columns[f"{n}_spans"] = pa.array([[{"start": a, "end": b} for a, b in o[k]] for o in out], spans)
            columns[f"{n}_words"] = pa.array([sum(b - a for a, b in o[k]) for o in out], pa.int64())
        tidy()
        return pa.table(columns)

    needed = blocks.select("block", "ids", "keys", "chunks", "place", "sizes", "least")
    return needed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(mark, schema)


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the removed spans cut out of their texts; rows with no repeated passage, and all other columns, are as before.

    Rows that share an id but not the text are cut by the spans of each found for the id only
    where the id is unique; otherwise they are left as they are.
    """
    spans = find_repeats(docs, doc, text, min_words).select(F.col("doc_id").alias("__doc"), F.col("removed_spans").alias("__spans"))
    spans = spans.groupBy("__doc").agg(F.collect_set("__spans").alias("__all")).select("__doc", F.when(F.size("__all") == 1, F.col("__all")[0]).alias("__spans"))
    names, schema = docs.columns, docs.schema
    at, width = names.index(text), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for raw, null, cut in zip(raw_texts(part.column(at)), part.column(at).is_null().to_pylist(), part.column(width).to_pylist()):
                out.append(None if null else without(raw, [(c["start"], c["end"]) for c in cut or ()]).decode("utf-8", "replace"))
            columns = list(part.columns)[:width]
            columns[at] = pa.array(out, part.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.join(spans, docs[doc] == spans["__doc"], "left").drop("__doc").mapInArrow(run, schema)


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the words of the spans and the white space that follows each word."""
    if not spans:
        return raw
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.append(np.flatnonzero(first), len(raw))
    done, pieces = 0, []
    for a, b in spans:
        pieces.append(raw[done : starts[min(a, len(starts) - 1)]])
        done = int(starts[min(b, len(starts) - 1)])
    return b"".join([*pieces, raw[done:]])

"""Quality rules by importance of hashed n-grams.

Uni- and bigrams of a text's tokens (letters and digits; runs of other characters) are hashed
to ``BUCKETS``. Two multinomials over the buckets are fitted: one to all trusted documents,
one to all documents. A text's score is its log-likelihood ratio divided by
its number of n-grams; texts under the threshold go, always the same ones. Plain counting
rules come first.

The threshold keeps ``KEEP_CLEAN`` of the clean labelled documents that the ratios were not
fitted to: those that were score higher than any others. Toxicity is a score of its own: the
mean weight of the buckets that occur in clearly more toxic than trusted documents, with a
threshold from the same clean documents. It is told beside ``quality_kept`` and isn't part of it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import GONE_SLOTS, bounded_batches, discard, mixed, raw_texts, slices, stored, windows, with_columns, word_hashes

BUCKETS = 1 << 16
SMOOTHING = 1.0
#: Least mean log-likelihood ratio of a document that is kept, where there are no labels to fit it to.
THRESHOLD = -0.5
#: Share of the clean documents that each threshold keeps.
KEEP_CLEAN = 0.99
#: Standard errors by which a bucket's share of toxic documents is above its share of trusted ones.
TOXIC_Z = 4.0
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\x20\x09-\x0d]+")
_SPACE_AND_REST = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"


def ngram_buckets(raw: bytes) -> np.ndarray:
    """Buckets of the uni- and bigrams."""
    h = word_hashes(_TOKEN.findall(raw.lower()))
    return (np.concatenate([mixed(h), windows(h, 2)]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def bucket_counts(docs: DataFrame, text: str = "text", once: bool = False) -> np.ndarray:
    """n-grams in each bucket over all docs, or documents that have any (once): each task sends at most BUCKETS sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        pending, waiting = [], 0
        for part in slices(batches):
            for raw in raw_texts(part.column(0)):
                grams = ngram_buckets(raw)
                pending.append(np.unique(grams) if once else grams)
                waiting += len(pending[-1])
                if waiting >= BUCKETS:
                    total += np.bincount(np.concatenate(pending), minlength=BUCKETS)
                    pending, waiting = [], 0
        if pending:
            total += np.bincount(np.concatenate(pending), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    bounded_batches(docs.sparkSession)
    got = docs.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def labelled(docs: DataFrame, classes: dict[str, DataFrame], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, and whether its id is in each of the classes), for the rows of docs that are in any; null ids don't count.

    Of all other texts only those are shuffled that share one of the broadcast slots, at most GONE_SLOTS, with a labelled id.
    """
    each = [ids.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), *(F.lit(n == c).alias(c) for c in classes)) for n, ids in classes.items()]
    ids = reduce(DataFrame.unionByName, each).groupBy("__key").agg(*(F.bool_or(c).alias(c) for c in classes))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(GONE_SLOTS)).cast("int")
    may = docs.select(docs[key].alias("__id"), docs[text].alias("__text")).withColumn("__at", slot("__id"))
    may = may.join(F.broadcast(ids.select(slot("__key").alias("__at")).distinct()), "__at", "left_semi")
    return may.join(ids, F.col("__id") == F.col("__key")).select(F.col("__text").alias(text), *classes)


_SIGN = np.int64(0x7FFF_FFFF_FFFF_FFFF)


def order_statistics(values: DataFrame, ranks: dict[str, Callable[[int], int]]) -> dict[str, float]:
    """Of each double column that ranks names, the value at the place, from 0, that its function tells for the number of rows; none for an empty table.

    Exact: the bits of the place's value are found in four counts of all rows by 16 bits, so that no more than 65,536
    counts a column are looked at, however many rows there are.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j, column in enumerate(batch.columns):
                bits = column.to_numpy(zero_copy_only=False).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bits), j, np.int32)), pa.array(np.where(bits < 0, bits ^ _SIGN, bits))], names=["column", "key"])

    kept = stored(values.select(*ranks).mapInArrow(keys, "column int, key long"), "keys")
    found: dict[int, tuple[int, int]] = {}  # of each column: the upper bits of the value sought, and its place among the rows that have them
    for shift in (48, 32, 16, 0):
        own = reduce(lambda x, y: x | y, ((F.col("column") == j) & (F.shiftright("key", shift + 16) == upper) for j, (upper, _) in found.items()), F.lit(shift == 48))
        counts = kept.where(own).groupBy("column", F.shiftright("key", shift).alias("bits")).agg(F.count("*").alias("n")).orderBy("column", "bits").toArrow()  # at most 65,536 rows a column
        columns, bits, n = (counts[c].to_numpy() for c in ("column", "bits", "n"))
        for j, rank in enumerate(ranks.values()):
            mine = columns == j
            if mine.any():
                place = found[j][1] if j in found else rank(int(n[mine].sum()))
                ends = np.cumsum(n[mine])
                at = int(np.searchsorted(ends, place, "right"))
                found[j] = int(bits[mine][at]), place - int(ends[at] - n[mine][at])
    discard(kept)
    back = lambda key: float((np.int64(key) ^ _SIGN if key < 0 else np.int64(key)).view(np.float64))
    return {name: back(found[j][0]) for j, name in enumerate(ranks) if j in found}


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Per bucket: log P(target) - log P(raw). Without trusted n-grams all are 0."""
    if not target.sum():
        return np.zeros(BUCKETS, np.float32)
    a = np.log(target + smoothing) - np.log(target.sum() + smoothing * BUCKETS)
    b = np.log(raw + smoothing) - np.log(raw.sum() + smoothing * BUCKETS)
    return (a - b).astype(np.float32)


def toxic_weights(toxic: np.ndarray, n_toxic: int, trusted: np.ndarray, n_trusted: int, z: float = TOXIC_Z) -> np.ndarray:
    """Per bucket: the log-ratio of the shares of documents that have it, or 0 unless it is clearly above 0."""
    if not n_toxic or not n_trusted:
        return np.zeros(BUCKETS, np.float32)
    both = (toxic + trusted) / (n_toxic + n_trusted)
    error = np.sqrt(both * (1 - both) * (1 / n_toxic + 1 / n_trusted))
    ratio = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((trusted + 0.5) / (n_trusted + 1))
    return np.where((error > 0) & (toxic / n_toxic - trusted / n_trusted >= z * error), ratio, 0).astype(np.float32)


def mean_weight(grams: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[grams].astype(np.float64).sum() / len(grams)) if len(grams) else 0.0


class Model(NamedTuple):
    ratios: np.ndarray
    threshold: float
    toxic: np.ndarray
    toxic_threshold: float


def fit(docs: DataFrame, trusted: DataFrame, toxic: DataFrame, clean: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """The model of all labelled documents, given by their ids.

    trusted and clean are clean documents and share none; the thresholds come from clean
    alone. Without clean documents THRESHOLD holds and nothing is toxic.
    """
    known = stored(labelled(docs, {"trusted": trusted, "toxic": toxic, "clean": clean}, key, text), "labelled")
    of = {n: known.where(n).select(text) for n in ("trusted", "toxic", "clean")}
    ratios = log_ratios(bucket_counts(of["trusted"], text), bucket_counts(docs, text))
    weights = toxic_weights(bucket_counts(of["toxic"], text, True), of["toxic"].count(), bucket_counts(of["trusted"], text, True), of["trusted"].count())
    judged = judge(of["clean"], ratios, text, toxic=weights).where("not base_failed")
    cut = order_statistics(judged, {"quality_score": lambda n: math.floor((1 - KEEP_CLEAN) * (n - 1)), "quality_toxicity": lambda n: math.ceil(KEEP_CLEAN * (n - 1))})
    discard(known)
    return Model(ratios, cut.get("quality_score", THRESHOLD), weights, cut.get("quality_toxicity", math.inf))


def base_rules(raw: bytes) -> tuple[int, int, int, int, int]:
    """(words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    three = list(zip(words, words[1:], words[2:]))
    if len(set(three)) < len(three):
        often = {w for w, n in Counter(three).items() if n > 1}
        covered = 0
        for i, w in enumerate(three):
            if w in often:
                repeated += i + 3 - max(covered, i)
                covered = i + 3
    return len(words), len(raw.translate(None, _SPACE_AND_REST)), len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated


def judge(docs: DataFrame, ratios: np.ndarray, text: str = "text", threshold: float = THRESHOLD, toxic: np.ndarray | None = None, toxic_threshold: float = math.inf) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality_score, quality_kept, quality_toxicity and quality_toxic; existing columns of these names are replaced.

    A null or empty text has no words, scores 0 and fails the base rules. Each row is judged
    alone from its whole text, repeated rows alike; a score equal to the threshold is kept,
    a toxicity equal to its threshold isn't toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ratios, np.zeros(BUCKETS, np.float32) if toxic is None else toxic))

    def run(texts: list[bytes]) -> list[pa.Array]:
        base = [base_rules(t) for t in texts]
        grams = [ngram_buckets(t) for t in texts]
        score, toxicity = ([mean_weight(g, w) for g in grams] for w in shared.value)
        failed = [b[0] < MIN_WORDS or 100 * b[4] > MAX_REPEAT_PERCENT * b[0] for b in base]
        kept = [not f and s >= threshold for f, s in zip(failed, score)]
        return [pa.array([b[i] for b in base], pa.int64()) for i in range(5)] + [pa.array(failed), pa.array(score, pa.float64()), pa.array(kept, pa.bool_()), pa.array(toxicity, pa.float64()), pa.array([t > toxic_threshold for t in toxicity], pa.bool_())]

    fields = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("quality_score", T.DoubleType()), T.StructField("quality_kept", T.BooleanType())]
    fields += [T.StructField("quality_toxicity", T.DoubleType()), T.StructField("quality_toxic", T.BooleanType())]
    return with_columns(docs, text, fields, run)

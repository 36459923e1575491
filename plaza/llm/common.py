"""What the operators of this subpackage share: shared storage, Arrow batches, words and hashes."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import struct
import sys
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch, and of the part of it that is turned into Python objects at a time.
BATCH_ROWS, SLICE_ROWS = 1000, 250

_LIBC = ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6") if sys.platform == "linux" else None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset a local session gets one of its own, a cluster an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="plaza-shared-")  # one machine: everyone sees it
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of this session have at most BATCH_ROWS rows: texts are long, and several workers share an executor."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def tidy() -> None:
    """Gives back what a finished task leaves in its worker, which other tasks use again."""
    MEMO.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC:
        _LIBC.malloc_trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: lineage ends here, and a lost executor loses nothing."""
    bounded_batches(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/plaza-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = (weakref.ref(out), path)
    return out


#: Where the stored tables of this process lie that haven't been discarded.
_PATHS: dict[int, tuple[weakref.ref, str]] = {}


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables. Nothing that is still to be computed may read them."""
    for t in tables:
        ref, path = _PATHS.pop(id(t), (None, ""))
        if ref and ref() is t:
            spark = t.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Slots of the filter by which ``without_rows`` finds rows that may go.
GONE_SLOTS = 1 << 20


def without_rows(docs: DataFrame, gone: DataFrame, doc: str, text: str) -> DataFrame:
    """docs without the rows whose id (null is one) and hash of the text are in gone(id, key).

    Texts aren't shuffled but for those of rows that may go: these are found by a broadcast of
    the slots, at most GONE_SLOTS, that the rows of gone fall in, and then joined.
    """
    slot = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(GONE_SLOTS)).cast("int")
    slots = stored(gone.select(slot(F.col("id"), F.col("key")).alias("__slot")).distinct(), "slots")
    keyed = docs.withColumn("__key", F.xxhash64(docs[text])).withColumn("__at", slot(docs[doc], F.col("__key")))
    here = keyed["__at"] == slots["__slot"]
    may = keyed.join(F.broadcast(slots), here, "left_semi")
    gone = gone.select(F.col("id").alias("__id"), F.col("key").alias("__gone"))
    stay = may.join(gone, may[doc].eqNullSafe(gone["__id"]) & (may["__key"] == gone["__gone"]), "left_anti")
    return keyed.join(F.broadcast(slots), here, "left_anti").unionByName(stay).select(docs.columns)


#: A key with more rows is dealt to SALTS tasks.
HOT_ROWS, SALTS = 4096, 64


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """many joined with one, which has a row a key and, in the column n, how many rows of many have it.

    Rows of keys with more than HOT_ROWS are dealt to SALTS tasks by the column ``by``, and
    their row of one is sent to each. Hot keys are told by a broadcast of the slots, at most
    GONE_SLOTS, that they fall in; a key that shares a slot with one is dealt out, too.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(GONE_SLOTS)).cast("int")
    hot = F.broadcast(one.where(F.col("n") > HOT_ROWS).select(slot.alias("__hot")).distinct())
    is_hot, here = F.col("__hot").isNotNull(), F.col("__slot") == F.col("__hot")
    salted = many.withColumn("__slot", slot).join(hot, here, "left").withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(0)).drop("__slot", "__hot")
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    sent = one.drop("n").withColumn("__slot", slot).join(hot, here, "left").withColumn("__salt", F.explode(salts)).drop("__slot", "__hot")
    return salted.join(sent, [*keys, "__salt"], how).drop("__salt")


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of SLICE_ROWS; the worker is tidied at their end."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)
    tidy()


def with_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[list[bytes]], list[pa.Array]]) -> DataFrame:
    """df with columns computed from the bytes of its texts; columns of df with the same names are replaced."""
    bounded_batches(df.sparkSession)
    kept = df.drop(*(f.name for f in fields if f.name != text))
    names = [*kept.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([*part.columns, *make(raw_texts(part.column(text)))], names=names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


class WordHashes(dict):
    """Memo of word -> 64-bit hash. It is emptied when full, which changes no result."""

    full = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.full:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


MEMO = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(MEMO.__getitem__, words), np.uint64, len(words))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order. np.unique, asked for nothing else, hashes them, for many times the seconds and memory of a sort."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, in text order; none if there are fewer."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return mixed(out + np.uint64(size))


def longs(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array a row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


# --- packed numbers ---


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, lowest first, without the planes that are all zero."""
    values = np.ascontiguousarray(values, "<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<BQ", width, len(values)) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BQ", data)
    out = np.zeros((n, 8), np.uint8)
    if width:
        out[:, :width] = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[9:]), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def packed_count(data: bytes) -> int:
    return struct.unpack_from("<BQ", data)[1]


def packed_names(names: np.ndarray) -> bytes:
    """Names in ascending order, as packed differences."""
    return packed(np.diff(names, prepend=np.uint64(0)))


def unpacked_names(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def bounds(parts: int) -> np.ndarray:
    """Where the names of each part but the first begin."""
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def part_of(names: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 64-bit name; parts are ranges of names in ascending order."""
    return (((names >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of each run of equal values."""
    edge = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    yield from ((int(values[a]), a, z) for a, z in zip(edge, edge[1:]) if z > a)


def bucket_of_id(key: str = "doc_id", of: int = 4) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % of


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

"""Language identification by compression.

A text belongs to the language whose zstandard raw-content dictionary compresses it
to the fewest bytes. Texts are folded first (lower case, everything but letters to a
single space) and compressed in independent blocks, so that the dictionaries matter
as much at the end of a long text as at its start.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_columns

#: The label of texts without a letter.
UNDETERMINED = "und"
#: Bounds of the training sample: rows read for each language, bytes of each dictionary.
ROWS_PER_LANGUAGE, DICTIONARY_BYTES = 256, 32_768
#: Bytes compressed at a time.
BLOCK = 4096
LEVEL, MIN_MATCH = 6, 3
#: Results are rejected if the second-best language needs less than this share of bytes more.
MIN_MARGIN = 0.01

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LETTER = re.compile(rb"[A-Za-z]")
#: Texts of up to so many bytes are compressed in as many rotations, whose bytes are summed: one compression of a few words ties in whole bytes.
SHORT, ROTATIONS = 512, 16


def has_letter(raw: bytes) -> bool:
    return bool(_LETTER.search(raw)) or not raw.isascii() and any(map(str.isalpha, raw.decode("utf-8", "replace")))


def rotations(text: bytes) -> list[bytes]:
    """A short folded text, begun anew at ROTATIONS of its words, or at each if it has fewer."""
    words = text.split()
    step = max(1, len(words) // ROTATIONS)
    return [b" ".join(words[at:] + words[:at]) for at in range(0, len(words), step)]


def folded(raw: bytes) -> bytes:
    """Lower case; runs of ASCII characters other than letters become one space."""
    text = raw if raw.isascii() else raw.decode("utf-8", "replace").lower().encode("utf-8", "replace")
    return b" ".join(text.translate(_FOLD).split())


def train_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE, dictionary_bytes: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """A raw-content dictionary for each language, most frequent language first.

    All languages are learned. Each is bounded by the two parameters: the ``rows_per_language`` rows with the
    least hash of the key are read, their distinct segments (at most 512 characters) are
    dealt into the dictionary by hash until it has ``dictionary_bytes``. Rows with a null
    language or key don't count. No rows: no languages.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text")).where("lang is not null and key is not null")
    langs = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]  # a row a language
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    ids = rows.select("lang", "key").withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows_per_language).select("lang", "key").distinct().collect()
    picked = spark.createDataFrame([tuple(r) for r in ids], T.StructType([rows.schema["lang"], rows.schema["key"]]))
    segments = (
        rows.join(F.broadcast(picked), ["lang", "key"], "left_semi")
        .select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[^\n.]{1,512}"), F.lit(0))).alias("segment"))
        .distinct()
        .withColumn("size", F.octet_length("segment") + 1)
        .withColumn("upto", F.sum("size").over(Window.partitionBy("lang").orderBy(F.xxhash64("segment"), "segment")))
        .where(F.col("upto") <= 2 * dictionary_bytes)
        .collect()
    )
    out = []
    for name in langs:
        own = sorted((r.upto, r.segment) for r in segments if r.lang == name)
        content = b" ".join(dict.fromkeys(filter(None, (folded(s.encode()) for _, s in own))))
        out.append((name, content[:dictionary_bytes]))
    return out


def _compressors(dictionaries: list[tuple[str, bytes]]) -> list:
    made = []
    for _, content in dictionaries:
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(content), source_size=BLOCK, min_match=MIN_MATCH, write_checksum=False, write_content_size=False, write_dict_id=False)
        if len(content) < 8:  # too short for a dictionary
            made.append(zstandard.ZstdCompressor(compression_params=params).compress)
            continue
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        made.append(zstandard.ZstdCompressor(compression_params=params, dict_data=d).compress)
    return made


def classify(raw: bytes, names: list[str], compress: list, min_margin: float) -> tuple[str, float, bool]:
    """(language, margin from 0 to 1, rejected) of one text."""
    if not names or not has_letter(raw):
        return UNDETERMINED, 0.0, True
    text = folded(raw)
    blocks = rotations(text) if len(text) <= SHORT else [text[at : at + BLOCK] for at in range(0, len(text), BLOCK)]
    sizes = [sum(len(f(b)) for b in blocks) for f in compress]
    best = min(range(len(names)), key=sizes.__getitem__)  # at a tie the more frequent language
    if len(names) == 1:
        return names[0], 1.0, False
    second = min(s for i, s in enumerate(sizes) if i != best)
    margin = (second - sizes[best]) / second if second else 0.0
    return names[best], margin, margin < min_margin


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """docs with lang_pred, lang_score (0 to 1) and lang_rejected; existing columns of these names are replaced.

    A null, empty or letterless text is ``und`` with score 0 and rejected, and so is every
    text if no language was learned. Each row is judged alone from its whole text: repeated
    rows and ties don't influence each other, no other column is read.
    """
    names = [name for name, _ in dictionaries]
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    made: list = []

    def judge(texts: list[bytes]) -> list[pa.Array]:
        if not made:
            made.extend(_compressors(shared.value))
        rows = [classify(t, names, made, min_margin) for t in texts]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_rejected", T.BooleanType())]
    return with_columns(docs, text, fields, judge)

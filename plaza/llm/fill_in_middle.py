"""Fill-in-middle: a text is cut at two unit boundaries and its parts are written in another order.

A table-driven automaton over bytes reads the texts of a slice of rows once. Its state holds what
the last bytes say: whether a unit is open and in its white space or in its word, and how much of
a sentinel has been read. Each transition has marks: a character begins here (any byte but a UTF-8
continuation), a unit begins here, a sentinel ends here. Marks are counted for each text; the
second pass finds the bytes at which the drawn units begin, and counts the characters up to them.

As the state depends on the last few bytes only, the scan needn't go byte after byte through a
text: the texts are laid end to end, with a byte between them that no text has, and this stretch
is divided into lanes that are read side by side, each from LOOK_BACK bytes before its own.

The drawn numbers follow from the seed and the document's id alone, so a lost task gives the same
rows when it is run again.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, raw_texts, slices

#: Bytes of white space; a unit is white space and the word after it, or white space at the end.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: A byte that is in no UTF-8 text; it ends a text and takes the automaton to its start.
STOP = 0xFF
CHARACTER, UNIT, SENTINEL = 1, 2, 4
#: Bytes that a lane reads before its own. After so many the state no longer depends on where it began.
LOOK_BACK = 4
LANES = 4096


@dataclasses.dataclass(frozen=True)
class Rules:
    """How documents are drawn and written; ``changed`` and ``spm`` are hundredths."""

    seed: int = 42
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    changed: int = 50
    spm: int = 80

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or not all(marks) or any(a[0] in b[1:] for a in marks for b in marks):
            raise ValueError("sentinels must differ, and the first character of one must be nowhere else in them: else an output can't be read back")

    @property
    def sentinels(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


class Scanner:
    """The automaton of some sentinels: for each state and byte the next state, and the transition's marks."""

    def __init__(self, sentinels: tuple[bytes, ...]) -> None:
        # what may have been read of a sentinel: all beginnings of sentinels
        read = sorted({s[:k] for s in sentinels for k in range(len(s))})
        inside = ("start", "white", "word")
        states = [(where, part) for where in inside for part in read]
        number = {s: i for i, s in enumerate(states)}
        self.start = number["start", b""]
        self.next = np.zeros((len(states), 256), np.uint8 if len(states) < 256 else np.uint16)
        self.marks = np.zeros((len(states), 256), np.uint8)
        for (where, part), i in number.items():
            for b in range(256):
                if b == STOP:
                    self.next[i, b] = self.start
                    continue
                got = part + bytes([b])
                ends = any(got.endswith(s) for s in sentinels)
                rest = next(got[k:] for k in range(len(got) + 1) if got[k:] in read)
                white = b in WHITE
                self.next[i, b] = number["white" if white else "word", rest]
                self.marks[i, b] = CHARACTER * (b & 0xC0 != 0x80) + UNIT * (where == "start" or where == "word" and white) + SENTINEL * ends
        self.look_back = max(LOOK_BACK, max(map(len, sentinels)) + 1)

    def scan(self, data: np.ndarray) -> np.ndarray:
        """The marks of each byte of texts with a STOP after each."""
        lanes = min(LANES, -(-len(data) // (4 * self.look_back))) or 1
        own = -(-len(data) // lanes)
        padded = np.full(self.look_back + lanes * own, STOP, np.uint8)
        padded[self.look_back : self.look_back + len(data)] = data
        at = np.arange(lanes) * own  # in padded: where each lane begins to look back
        state = np.full(lanes, self.start, np.int64)
        marks = np.empty((own, lanes), np.uint8)
        flat_next, flat_marks = self.next.ravel(), self.marks.ravel()
        for step in range(self.look_back + own):
            edge = state * 256 + padded[at + step]
            if step >= self.look_back:
                marks[step - self.look_back] = flat_marks[edge]
            state = flat_next[edge].astype(np.int64)
        return marks.T.ravel()[: len(data)]


def _draws(seed: int, doc: str) -> list[Column]:
    """Four unsigned numbers from the digest of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


FIELDS = [
    T.StructField("fim_units", T.LongType()),
    T.StructField("fim_form", T.StringType()),
    T.StructField("fim_prefix_chars", T.LongType()),
    T.StructField("fim_middle_chars", T.LongType()),
    T.StructField("fim_text", T.StringType()),
]


def transform(docs: DataFrame, rules: Rules = Rules(), doc: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """docs with the transformed text and how it was made.

    fim_units: units of the text. fim_form: plain (the text as it is), psm (prefix, suffix,
    middle) or spm (suffix, prefix, middle). fim_prefix_chars, fim_middle_chars: code points of the
    parts, null if plain. fim_text: the output, from which ``restored`` gives the text again.

    Null and empty texts are plain and give an empty text; a text that contains a sentinel is
    plain. Rows aren't shuffled: repeated rows give equal rows. Columns of docs with these names
    are replaced, others stay; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    if {doc, text} & {f.name for f in FIELDS}:
        raise ValueError("id and text can't be columns that the operator makes")
    kept = docs.drop(*(f.name for f in FIELDS))
    draws = [f"fim_draw_{k}" for k in range(4)]
    while set(draws) & set(kept.columns):
        draws = [f"{c}_" for c in draws]
    rows = kept.withColumns(dict(zip(draws, _draws(rules.seed, doc), strict=True)))
    scanner = Scanner(rules.sentinels)
    own = kept.columns
    names = [*own, *(f.name for f in FIELDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            drawn = np.stack([part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in draws]) if part.num_rows else np.empty((4, 0), np.int64)
            made = transformed(raw_texts(part.column(text)), drawn, rules, scanner)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *made], names=names)

    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, *FIELDS]))


def transformed(texts: list[bytes], draws: np.ndarray, rules: Rules, scanner: Scanner) -> list[pa.Array]:
    """The columns FIELDS of texts; draws has four numbers for each."""
    p, s, m = rules.sentinels
    data = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
    marks = scanner.scan(data)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    begins = ends - [len(t) + 1 for t in texts]
    # first pass: counted transitions
    units = np.flatnonzero(marks & UNIT)
    first = np.searchsorted(units, begins)
    n = np.searchsorted(units, ends) - first
    sentinels = np.flatnonzero(marks & SENTINEL)
    plain = (n == 0) | (np.searchsorted(sentinels, ends) > np.searchsorted(sentinels, begins)) | (draws[2] % 100 >= rules.changed)
    cuts = np.sort(draws[:2] % (n + 1), axis=0)
    spm = draws[3] % 100 < rules.spm
    # second pass: the bytes where the drawn units begin, and the characters up to there
    after = np.append(units, 0)
    at = np.where(cuts < n, after[np.minimum(first + cuts, len(units))], ends - 1) - begins
    chars = np.flatnonzero(marks & CHARACTER)
    of = np.searchsorted(chars, at + begins) - np.searchsorted(chars, begins)
    forms, out = [], []
    for i, t in enumerate(texts):
        if plain[i]:
            forms.append("plain")
            out.append(t)
            continue
        before, between, behind = t[: at[0, i]], t[at[0, i] : at[1, i]], t[at[1, i] :]
        forms.append("spm" if spm[i] else "psm")
        out.append(b"".join((s, behind, p, before, m, between) if spm[i] else (p, before, s, behind, m, between)))
    return [
        pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(of[0], pa.int64(), mask=plain), pa.array(of[1] - of[0], pa.int64(), mask=plain),
        pa.array(out, pa.binary()).view(pa.string()),
    ]


def restored(output: Column, form: Column, rules: Rules = Rules()) -> Column:  # noqa: B008
    """The text that an output of ``transform`` was made from. The parts hold no sentinel, so each is found by its first place."""
    p, s, m = (F.lit(x) for x in (rules.prefix, rules.suffix, rules.middle))
    after = lambda mark: F.substr(output, F.position(mark, output) + F.length(mark))
    until = lambda rest, mark: F.substr(rest, F.lit(1), F.position(mark, rest) - 1)
    between = after(m)
    spm = F.concat(until(after(p), m), between, until(after(s), p))
    psm = F.concat(until(after(p), s), between, until(after(s), m))
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)

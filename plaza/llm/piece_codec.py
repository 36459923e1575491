"""SentencePiece encoding and decoding, for BPE models: merge rounds over flat arrays of symbols.

A text gets a word mark in front, and its spaces become marks. It is cut into words of marks and
what follows them; no piece of such a model has a mark after another character, so no merge crosses
a cut. The distinct words of a slice of rows, but for those remembered, lie one after another in a
flat array of symbols. A round finds the smallest rank among the adjacent pairs of each segment,
merges all its occurrences from the left, none overlapping, and closes the gaps. Segments that have
no pair left are taken out; rounds end when none remains.

All occurrences may be merged at once unless one makes a new pair that precedes the others (of
rank no larger): then that one is the last that is merged in the round. A segment is a stretch of
a word that no later merge leaves: between two symbols whose texts together are within no piece
there is a border from then on, so long words without spaces fall apart into many segments that
are merged side by side.

Pieces of marks alone share the last rank. As no other piece has two marks, they wait until
nothing else can be merged, and a run of m marks is then cut once for each m, from the left.

Characters that no piece covers become one piece a byte. Decoding joins the pieces' bytes, takes
the first mark away and writes U+FFFD for each byte that is no part of a character.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bounded_batches, lists, slices, with_columns

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Ranks of pairs that are within a piece but none themselves, and of pairs that no merge joins.
LATER, NEVER = np.int32(2**30), np.int32(2**30 + 1)
#: Words that a task remembers; beyond it starts anew, which changes no result.
MAX_WORDS = 400_000
#: Characters of new words that are merged together; a longer word is a part of its own.
PART_CHARS = 1 << 20

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class PairTable:
    """(left symbol, right symbol) -> rank and merged symbol, by open addressing in arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]) -> None:
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NEVER, np.int32)
        self.made = np.full(1 << self.bits, -1, np.int32)
        keys = [left << 32 | right for left, right in pairs]
        slots = self._slot(np.array(keys, np.int64)).tolist() if keys else []
        taken: dict[int, int] = {}
        for k, at in enumerate(slots):
            while at in taken:
                at = (at + 1) & (len(self.keys) - 1)
            taken[at] = k
        where, which = np.fromiter(taken.keys(), np.int64, len(taken)), np.fromiter(taken.values(), np.int64, len(taken))
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        self.keys[where], self.rank[where], self.made[where] = np.array(keys, np.int64)[which], values[which, 0], values[which, 1]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair; that of an unknown pair is empty, of rank NEVER. Negative symbols are unknown."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = 2**62
        at = self._slot(keys)
        seen = self.keys[at]
        (open_,) = np.nonzero((seen != keys) & (seen >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            open_ = open_[(seen != keys[open_]) & (seen >= 0)]
        return at


class PieceModel:
    """A BPE model: its pieces and the pairs that merge. It is made on the driver and broadcast; its size is that of the vocabulary."""

    def __init__(self, pieces: list[tuple[str, float, int]]) -> None:
        self.kinds = [kind for _, _, kind in pieces]
        ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.surface = [f" {chr(0x2047)} ".encode() if kind == UNKNOWN else b"" if kind == CONTROL else bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in pieces]
        self.bytes_ = np.full(256, self.unknown, np.int32)
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                self.bytes_[self.surface[i][0]] = i
        ranks = {s: r for r, s in enumerate(sorted({pieces[i][1] for i in ids.values()}, reverse=True))}
        rank = {p: ranks[pieces[i][1]] for p, i in ids.items()}
        marks = {p for p in ids if len(p) > 1 and not p.strip(MARK)}
        others = [p for p in ids if len(p) > 1 and p not in marks]
        if any(MARK in p[1:] for p in others) or max((rank[p] for p in others), default=-1) >= min((rank[p] for p in marks), default=2**30):
            raise ValueError("in this model a piece has a mark after another character, or marks come before other pieces")
        self.marks = frozenset(map(len, marks))
        # symbols: the pieces by their ids, then characters that are within pieces but none themselves
        symbols = ids | {c: len(pieces) + k for k, c in enumerate(sorted({c for p in others for c in p} - ids.keys()))}
        self.n_pieces = len(pieces)
        self.char_of = np.array([0] * len(pieces) + [ord(c) for c, i in symbols.items() if i >= len(pieces)], np.int32)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for p in others:
            for a in range(len(p) - 1):
                for b in range(a + 2, len(p) + 1):
                    whole = p[a:b]
                    made = (rank[whole], ids[whole]) if whole in ids else (int(LATER), -1)
                    for k in range(a + 1, b):
                        if (x := symbols.get(p[a:k])) is not None and (y := symbols.get(p[k:b])) is not None:
                            pairs[x, y] = made
        self.pairs = PairTable(pairs)
        # pieces from which a merge of no larger rank may follow
        self.leads = np.zeros(len(symbols) + len(pieces), bool)
        own = {i: rank[p] for p, i in ids.items()}
        for (x, y), (r, _) in pairs.items():
            for z in (x, y):
                self.leads[z] |= r < LATER and z in own and r <= own[z]
        self.memo: dict[str, bytes] = {}

    # --- encoding ---

    def merged(self, chars: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words that lie one after another, and the word of each. A character without a symbol is -1 - its code."""
        place = np.arange(len(chars))
        sym = self.symbol_of[chars]
        done = np.where(sym < 0, -1 - chars.astype(np.int32), sym)  # what stands at each place when it is reached no more
        gone = np.zeros(len(chars), bool)  # merged into the symbol before
        at = self.pairs.find(sym[:-1], sym[1:])
        rank = np.append(np.where(words[:-1] == words[1:], self.pairs.rank[at], NEVER), NEVER).astype(np.int32)
        made = np.append(self.pairs.made[at], -1)
        while len(sym):
            # segments end where no merge goes on; take out those without a pair
            ends = rank == NEVER
            starts = np.flatnonzero(np.append(True, ends[:-1]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            live = np.repeat(least < LATER, sizes)
            if not live.all():
                done[place[~live]] = np.where(sym[~live] >= 0, sym[~live], done[place[~live]])
                place, sym, rank, made = place[live], sym[live], rank[live], made[live]
                sizes, least = sizes[least < LATER], least[least < LATER]
                if not len(sym):
                    break
            segment = np.repeat(np.arange(len(sizes)), sizes)
            least = least[segment]
            (hit,) = np.nonzero(rank == least)
            # every other one of overlapping occurrences, from the left; they have neighbouring places
            fresh = np.append(True, np.diff(hit) > 1)
            turn = np.arange(len(hit)) - np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[turn % 2 == 0]
            new = made[hit]
            if (hot := self.leads[new]).any():
                hit, new = self._first(hit, new, hot, sym, segment, least)
            sym[hit] = new
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            gone[place[hit + 1]] = True
            shift = np.cumsum(stay) - 1
            rank[hit] = rank[hit + 1]  # a border behind the pair is behind the merged symbol
            place, sym, rank, made = place[stay], sym[stay], rank[stay], made[stay]
            own = shift[hit]
            changed = np.zeros(len(sym), bool)
            changed[own] = changed[own[own > 0] - 1] = True
            (look,) = np.nonzero(changed & (rank != NEVER))
            at = self.pairs.find(sym[look], sym[np.minimum(look + 1, len(sym) - 1)])
            rank[look], made[look] = self.pairs.rank[at], self.pairs.made[at]
        return done[~gone], words[~gone]

    def _first(self, hit: np.ndarray, new: np.ndarray, hot: np.ndarray, sym: np.ndarray, segment: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each segment the occurrences up to the first that makes a pair of no larger rank."""
        n = len(sym)
        left = np.where(hit > 0, sym[np.maximum(hit - 1, 0)], -1)
        joined = np.append(False, hit[1:] == hit[:-1] + 2)  # the occurrence before is the left neighbour
        left[joined] = new[np.flatnonzero(joined) - 1]
        left[(hit > 0) & (segment[np.maximum(hit - 1, 0)] != segment[hit])] = -1
        right = np.where(hit + 2 < n, sym[np.minimum(hit + 2, n - 1)], -1)
        right[(hit + 2 < n) & (segment[np.minimum(hit + 2, n - 1)] != segment[hit])] = -1
        stops = np.zeros(len(hit), bool)
        (k,) = np.nonzero(hot)
        r = np.minimum(self.pairs.rank[self.pairs.find(left[k], new[k])], self.pairs.rank[self.pairs.find(new[k], right[k])])
        stops[k] = r <= least[hit[k]]
        total = np.cumsum(stops) - stops  # stops before
        of = segment[hit]
        first = np.append(True, of[1:] != of[:-1])
        keep = total == total[np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))]
        return hit[keep], new[keep]

    @functools.lru_cache(4096)  # noqa: B019  one model a worker
    def _of_marks(self, m: int) -> list[int]:
        """m marks in a row: the leftmost pair that is a piece, again and again."""
        out: list[int] = []
        for _ in range(m):
            out.append(1)
            while len(out) > 1 and out[-2] + out[-1] in self.marks:
                out[-2:] = [out[-2] + out[-1]]
        return out

    def _encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as int32."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        sym, of = self.merged(chars, of)
        odd = np.flatnonzero((sym < 0) | (sym >= self.n_pieces))
        mark = self.symbol_of[ord(MARK)]
        runs = np.flatnonzero((sym[1:] == mark) & (sym[:-1] == mark) & (of[1:] == of[:-1])) if self.marks else odd[:0]
        if len(odd) or len(runs):
            sym, of = self._spelled(sym, of, mark)
        cut = np.searchsorted(of, np.arange(len(words) + 1)) * 4
        data = sym.astype("<i4").tobytes()
        return [data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def _spelled(self, sym: np.ndarray, of: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as bytes, runs of marks as the pieces of marks."""
        start = np.append(True, (of[1:] != of[:-1]) | (sym[1:] != mark) | (sym[:-1] != mark))  # of a symbol, or of a run of marks
        (at,) = np.nonzero(start)
        many = np.diff(np.append(at, len(sym)))
        lengths = {k: self._ids_of_marks[k] for k in self.marks} | {1: mark}
        count = np.ones(len(at), np.int64)
        other: dict[int, list[int]] = {}
        for k in np.flatnonzero((many > 1) | (sym[at] < 0) | (sym[at] >= self.n_pieces)).tolist():
            s = int(sym[at[k]])
            if many[k] > 1:
                other[k] = [lengths[m] for m in self._of_marks(int(many[k]))]
            else:
                other[k] = self.bytes_[list(chr(-1 - s if s < 0 else int(self.char_of[s])).encode())].tolist()
            count[k] = len(other[k])
        flat = np.repeat(sym[at], count)
        offset = np.cumsum(count) - count
        for k, ids in other.items():
            flat[offset[k] : offset[k] + count[k]] = ids
        return flat, np.repeat(of[at], count)

    @functools.cached_property
    def _ids_of_marks(self) -> dict[int, int]:
        return {len(s.decode()): i for i, s in enumerate(self.surface) if self.kinds[i] == NORMAL and s and not s.strip(b" ")}

    def _learn(self, words: set[str]) -> None:
        part: list[str] = []
        size = 0
        for w in words:
            if part and size + len(w) > PART_CHARS:
                self.memo.update(zip(part, self._encode(part), strict=True))
                part, size = [], 0
            part.append(w)
            size += len(w)
        if part:
            self.memo.update(zip(part, self._encode(part), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        words = set().union(*cut)
        new = words - self.memo.keys()
        if len(self.memo) + len(new) > MAX_WORDS:
            self.memo.clear()
            new = words
        self._learn(new)
        return [np.frombuffer(b"".join(map(self.memo.__getitem__, ws)), "<i4") for ws in cut]

    # --- decoding ---

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Control pieces have none."""
        return self._joined(ids, list(map(self.surface.__getitem__, ids)))

    def decode_all(self, ids: np.ndarray, cuts: list[int]) -> list[str]:
        """The texts of rows that lie one after another in ids, cut at cuts."""
        flat = ids.tolist()
        parts = list(map(self.surface.__getitem__, flat))
        return [self._joined(flat[a:b], parts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _joined(self, ids: list[int], parts: list[bytes]) -> str:
        for k, i in enumerate(ids):
            if self.kinds[i] != CONTROL:
                if self.kinds[i] == NORMAL:
                    parts[k] = parts[k].removeprefix(b" ")
                break
        data = b"".join(parts)
        try:
            return data.decode()
        except UnicodeDecodeError:
            return re.sub("[\udc80-\udcff]", "\ufffd", data.decode(errors="surrogateescape"))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}


def load_model(path: str) -> PieceModel:
    """The model of a file, which must be BPE with the identity normaliser, a mark in front and spaces kept."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    how = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or how.precompiled_charsmap or not how.add_dummy_prefix or how.remove_extra_whitespaces or not how.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with the identity normaliser, a mark in front and all spaces kept are known")
    pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
    if not {kind for *_, kind in pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("user-defined and unused pieces aren't known")
    return PieceModel(pieces)


def encode(docs: DataFrame, model: PieceModel, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """docs with the ids of each whole text, without begin or end; null and empty texts have none.

    Rows aren't shuffled, so ties and repeated rows stay as they are; a column of docs named as
    ids is replaced, others stay; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: list[bytes]) -> list[pa.Array]:
        return [lists(shared.value.encode([t.decode(errors="replace") for t in texts]), pa.int32())]

    return with_columns(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make)


def decode(rows: DataFrame, model: PieceModel, ids: str = "piece_ids", text: str = "piece_text") -> DataFrame:
    """rows with the text of each array of ids; null counts as empty. A column of rows named as text is replaced."""
    bounded_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = rows.drop(text) if text in rows.columns else rows
    names = [*kept.columns, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            column = part.column(ids)
            cuts = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))).tolist()
            texts = shared.value.decode_all(column.flatten().to_numpy(zero_copy_only=False), cuts)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())]))

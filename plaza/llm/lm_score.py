"""Language-model scoring with a weighted backoff automaton.

Tokens are words, lower-cased from A-Z, and one end token a document. The model is a trigram
model with absolute discounting that backs off to bigrams and to an add-``ALPHA`` unigram
model. As an automaton it has a root state, one for each history word and one for each pair of
neighbours; a state has an arc for each n-gram of the training documents that goes on from it,
weighted with its smoothed log-probability, and a failure arc to the state of its history
without the first word, weighted with the log of the mass left for all other words. A document
is one walk from left to right that carries state and adds up weights, through up to two failure
arcs a token. Nothing is cut: every word and pair is a history and every n-gram an arc, at
every size of the input.

Neither vocabulary nor n-grams are ever in one place. Documents are laid in blocks of about
``BLOCK_TOKENS`` where they are read (``encoded``: each token is the number of its word in the
block). A block asks for each of its distinct words, pairs and triples once, and tells how often
it has them itself: one packed request to each of the parts in which words are dealt by 64-bit
name. Pairs lie with their first word, triples with their pair. A part adds up what it was told
and answers all who asked (``_added``), in the order of the request, so that answers need no
names. The block then builds the automaton of its own n-grams and walks its documents
(``_walk``). So a corpus is tokenised once, its n-grams are shuffled once, as about six bytes
for each block that has them, and a frequent word costs a part one entry a block. Words and pairs
with a large share of all tokens (at most ``2 * HOT`` of each) have what goes on from them dealt
to parts of their own by the name of the next word.

In a part, an n-gram is told apart by a 64-bit name of its history and bits of its last word's: 48 of a
pair's, 40 of a triple's, whose history has fewer words after it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, distinct, mixed, packed, packed_count, packed_names, part_of, raw_texts, runs, slices, stored, tidy, unpacked, unpacked_names

ALPHA = 0.1
DISCOUNT = 0.75
#: Tokens of a block, about.
BLOCK_TOKENS = 2_000_000
#: Words, pairs and triples that a part adds up, about: each block counts what it has once.
PART_ENTRIES = 2_000_000
#: What goes on from words and pairs with more than one in HOT of all tokens is dealt out by the next word, too.
HOT = 1000
#: Tokens of a lane: a block's tokens are walked in lanes side by side, each from the state that the words before it lead to.
LANE = 512
#: Arcs that are looked up at a time while the automaton is built.
FOUND = 1 << 18
#: The end token; no word is empty.
END = b""


def tokens_of(raw: bytes) -> list[bytes]:
    out = raw.lower().split()
    out.append(END)
    return out


# --- blocks ---


class Numbers(dict):
    """word -> its number among the words of a block, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


class Hot(NamedTuple):
    """Names of the hot words in ascending order, hot pairs as two places among them, likewise (a word of a hot pair is hot), and where the parts of each begin, words first."""

    words: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def places(self, names: np.ndarray) -> np.ndarray:
        """Of each hot word, its place among these names, or -1."""
        at = np.minimum(np.searchsorted(names, self.words), len(names) - 1)
        return np.where(names[at] == self.words, at, -1)


class Block:
    """A block's distinct pairs and triples in ascending order; words are numbers below ``words``.

    pair_n tells how often it has them, or with ``own`` how many of these begin at its tokens; so does triple_n, which is told with ``own`` only.
    """

    def __init__(self, lengths: np.ndarray, words: int, tokens: np.ndarray, own: np.ndarray | None = None) -> None:
        self.lengths, self.words, self.tokens = lengths, words, tokens
        ends = np.cumsum(lengths) - 1
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        self.starts, self.end = ends + 1 - lengths, int(tokens[-1])
        at = np.flatnonzero(inner)  # places of the pairs' first words
        self.pairs, pair = np.unique(tokens[at] * words + tokens[at + 1], return_inverse=True)
        self.pair_n = np.bincount(pair if own is None else pair[own[at]], minlength=len(self.pairs))
        self.history, self.next = (x.astype(np.int32) for x in np.divmod(self.pairs, words))  # half the memory; a block has fewer than 2^31
        two = np.flatnonzero(np.diff(at) == 1)
        codes = pair[two] * words + tokens[at[two] + 2]
        triples = distinct(codes)
        if own is not None:
            told, n = np.unique(codes[own[at[two]]], return_counts=True)
            self.triple_n = np.zeros(len(triples), np.int64)
            self.triple_n[np.searchsorted(triples, told)] = n
        del pair, at, two, codes
        self.state, self.last = (x.astype(np.int32) for x in np.divmod(triples, words))

    @classmethod
    def of(cls, row: dict, words: int, own: np.ndarray | None = None) -> Block:
        return cls(unpacked(row["lengths"]).astype(np.int64), words, unpacked(row["tokens"]).astype(np.int64), own)

    def hot(self, hot: Hot, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair, whether its first word is hot and whether itself is, and the place of each hot pair among the pairs or -1; at has the places of the hot words."""
        words, pairs, place = np.zeros(self.words, bool), np.zeros(len(self.pairs), bool), np.full(len(hot.pairs), -1)
        words[at[at >= 0]] = True
        if len(place) and len(self.pairs):
            first, second = at[hot.pairs].T
            codes = first * self.words + second
            found = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            here = (first >= 0) & (second >= 0) & (self.pairs[found] == codes)
            place[here] = found[here]
            pairs[found[here]] = True
        return words[self.history], pairs, place


_HEAVY = pa.list_(pa.struct([("word", pa.int64()), ("after", pa.int64()), ("n", pa.int64())]))


def _block(name: int, ids: list, train: list, numbers: Numbers, docs: list[np.ndarray], doc_type: pa.DataType) -> pa.RecordBatch:
    """One row: a block's documents, its words by name, and its tokens as places in the words."""
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    words, place = np.unique(names, return_inverse=True)
    b = Block(np.array([len(d) for d in docs]), len(words), place[np.concatenate(docs)])
    signed = words.view(np.int64)
    heavy = []
    for n, first, after in ((np.bincount(b.tokens), np.arange(len(words)), None), (b.pair_n, b.history, b.next)):
        most = np.flatnonzero(n * HOT > len(b.tokens))
        seconds = [None] * len(most) if after is None else signed[after[most]].tolist()
        heavy += [{"word": w, "after": x, "n": k} for w, x, k in zip(signed[first[most]].tolist(), seconds, n[most].tolist())]
    columns = [
        pa.array([name], pa.int64()), pa.array([ids], pa.list_(doc_type)), pa.array([train], pa.list_(pa.bool_())), pa.array([packed(b.lengths)], pa.binary()),
        pa.array([packed_names(words)], pa.binary()), pa.array([packed(b.tokens)], pa.binary()),
        pa.array([len(words) + len(b.pairs) + len(b.state)], pa.int64()), pa.array([len(b.tokens)], pa.int64()), pa.array([heavy], _HEAVY),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "train", "lengths", "words", "tokens", "entries", "size", "heavy"])


def encoded(docs: DataFrame, training: Column, doc: str, text: str) -> DataFrame:
    """One row for each block of documents; blocks are made where the documents are read."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.coalesce(training, F.lit(False)).alias("train"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        numbers, found, ids, train, size = Numbers(), [], [], [], 0
        kind = None
        for part in slices(batches):
            kind = part.column(0).type
            for key, own, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), raw_texts(part.column(2))):
                tokens = tokens_of(raw)
                found.append(np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens)))
                ids.append(key)
                train.append(own)
                size += len(tokens)
                if size >= BLOCK_TOKENS:
                    yield _block(first + made, ids, train, numbers, found, kind)
                    made, size = made + 1, 0
                    numbers, found, ids, train = Numbers(), [], [], []
        if found:
            yield _block(first + made, ids, train, numbers, found, kind)
        del numbers, found, ids, train
        tidy()  # once more: the last block came after the slices

    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[doc].dataType))]
        + T.StructType.fromDDL("train array<boolean>, lengths binary, words binary, tokens binary, entries long, size long, heavy array<struct<word: long, after: long, n: long>>").fields
    )
    return rows.mapInArrow(run, schema)


# --- requests and answers ---

_PACKED = ["words", "word_n", "fan", "codes", "pair_n", "fan3", "codes3", "triple_n"]


def _requests(row: dict, parts: int, hot: Hot) -> Iterator[tuple]:
    """What a block asks: (part, block, words, their numbers of training tokens, pairs of each word, codes of the pairs, their numbers in training, and the last three of the triples).

    Parts from hot.first[j] on are those of the hot word j alone, then those of the hot pairs;
    requests to these have no words, or only triples.
    """
    words, lengths = unpacked_names(row["words"]), unpacked(row["lengths"]).astype(np.int64)
    own = np.repeat(np.array(row["train"], bool), lengths)
    b = Block.of(row, len(words), own)
    word_n = np.bincount(b.tokens[own], minlength=len(words))
    code, code3 = words >> np.uint64(16), words >> np.uint64(24)
    hot_at = hot.places(words)
    hot_history, hot_pair, place = b.hot(hot, hot_at)

    def pairs_of(mine: np.ndarray) -> tuple[np.ndarray, Callable[[int, int], tuple]]:
        """The first words of these pairs, and what is asked of a range of them and of their triples; those of hot pairs aren't among them."""
        kept = (mine & ~hot_pair)[b.state]
        codes, numbers, fan = code[b.next[mine]], b.pair_n[mine], np.bincount(b.state[kept], minlength=len(b.pairs))[mine]
        codes3, numbers3, edge = code3[b.last[kept]], b.triple_n[kept], np.concatenate([[0], np.cumsum(fan)])
        return b.history[mine], lambda p, q: (packed(codes[p:q]), packed(numbers[p:q]), packed(fan[p:q]), packed(codes3[edge[p] : edge[q]]), packed(numbers3[edge[p] : edge[q]]))

    history, asked = pairs_of(~hot_history)
    for part, a, z in runs(part_of(words, parts)):
        p, q = np.searchsorted(history, np.array([a, z], history.dtype))
        fan = np.bincount(history[p:q] - a, minlength=z - a)
        yield part, row["block"], packed_names(words[a:z]), packed(word_n[a:z]), packed(fan), *asked(p, q)
    history, asked = pairs_of(hot_history)
    after = words[b.next[hot_history]]
    spans = np.diff(hot.first)
    for j, at in enumerate(hot_at):
        p, q = np.searchsorted(history, np.array([at, at + 1], history.dtype)) if at >= 0 else (0, 0)
        for s, x, y in runs(part_of(after[p:q], int(spans[j]))):
            yield int(hot.first[j]) + s, row["block"], None, None, None, *asked(p + x, p + y)
    for j, at in enumerate(place, len(hot.words)):
        p, q = np.searchsorted(b.state, np.array([at, at + 1], b.state.dtype)) if at >= 0 else (0, 0)
        for s, x, y in runs(part_of(words[b.last[p:q]], int(spans[j]))):
            yield int(hot.first[j]) + s, row["block"], *[None] * 6, packed(code3[b.last[p + x : p + y]]), packed(b.triple_n[p + x : p + y])


def _joined(packs: list[bytes | None], read: Callable[[bytes], np.ndarray] = unpacked) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *(read(x) for x in packs if x is not None)])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each is first, the place of each key among them, and their sums of n."""
    names, one, place = np.unique(keys, return_index=True, return_inverse=True)
    return names, one, place, np.bincount(place, n, len(names))


def _gone_on(names: np.ndarray, owner: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return mixed(names[owner] * np.uint64(0x9E3779B97F4A7C15) + codes)


def _added(table: pa.Table, hot: int, of_pair: bool) -> pa.Table:
    """The answers of one part, of a hot history (a word or, of_pair, a pair) or none (-1), and in its first row the part's sums: distinct training words, training tokens, arcs of the hot history."""
    packs = {n: table[n].to_pylist() for n in _PACKED}
    words, inverse = np.unique(_joined(packs["words"], unpacked_names), return_inverse=True)
    c = np.bincount(inverse, _joined(packs["word_n"]), len(words))
    owner = np.repeat(inverse, _joined(packs["fan"]).astype(np.int64))
    codes = _joined(packs["codes"])
    pairs, one, pair, pair_c = _summed(codes if hot >= 0 else _gone_on(words, owner, codes), _joined(packs["pair_n"]))
    t = np.bincount(owner[one[pair_c > 0]], minlength=len(words)) if hot < 0 else np.zeros(0)
    owner = np.repeat(pair, _joined(packs["fan3"]).astype(np.int64))
    codes = _joined(packs["codes3"])
    _, one, triple, triple_c = _summed(codes if of_pair else _gone_on(pairs, owner, codes), _joined(packs["triple_n"]))
    pair_t = np.zeros(0) if of_pair else np.bincount(owner[one[triple_c > 0]], minlength=len(pairs))
    columns = {"block": table["block"], "part": table["part"], "hot": np.full(table.num_rows, hot, np.int64)}
    for key, place, answers in (("words", inverse, {"c": c, "t": t}), ("codes", pair, {"pair_c": pair_c, "pair_t": pair_t}), ("codes3", triple, {"triple_c": triple_c})):
        cut = np.cumsum([0 if x is None else packed_count(x) for x in packs[key]])[:-1]
        columns |= {n: pa.array([packed(x[own]) for own in np.split(place, cut)], pa.binary()) for n, x in answers.items()}
    sums = int((c > 0).sum()), int(c.sum()), int(((triple_c if of_pair else pair_c) > 0).sum())
    return pa.table(columns | {n: pa.array([s] + [0] * (table.num_rows - 1), pa.int64()) for n, s in zip(("v", "n", "arcs"), sums)})


# --- the automaton ---


class Level:
    """The states of histories of one length, numbered from first on, and their arcs in ascending order of state and word."""

    def __init__(self, first: int, codes: np.ndarray, weight: np.ndarray, target: np.ndarray, failure: np.ndarray, suffix: np.ndarray) -> None:
        self.first, self.weight, self.target, self.failure, self.suffix = first, weight, target, failure, suffix
        self._told = np.append(codes, -1)
        self.codes = self._told[:-1]

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(codes)  # neighbours are looked up one after another
        arc = np.empty(len(codes), np.int64)
        arc[order] = np.searchsorted(self.codes, codes[order])
        return arc, self._told[arc] == codes


class Automaton:
    """States: 0 the root, 1 + u that of the word u, 1 + words + p that of the training pair p. An end token leads to the root."""

    def __init__(self, words: int, root: np.ndarray, begun: np.ndarray, levels: list[Level]) -> None:
        self.words, self.root, self.begun, self.levels = words, root, begun, levels  # levels: the longest histories first

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weights of the arcs that the words take from these states, failure arcs first, and the states that they lead to."""
        state, weight, out, going = state.copy(), np.zeros(len(word)), np.zeros(len(word), np.int64), np.ones(len(word), bool)
        for level in self.levels:
            here = np.flatnonzero(going & (state >= level.first))
            own = state[here] - level.first
            arc, found = level.find(own * self.words + word[here])
            hit, miss, arc, own = here[found], here[~found], arc[found], own[~found]
            weight[hit] += level.weight[arc]
            out[hit] = level.target[arc]
            going[hit] = False
            weight[miss] += level.failure[own]
            state[miss] = level.suffix[own]
        rest = np.flatnonzero(going)
        weight[rest] += self.root[word[rest]]
        out[rest] = self.begun[word[rest]]
        return weight, out

    def reached(self, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The states in which a walk is before these places; the last token is an end, so that a walk begins as it goes on after one."""
        singles = self.levels[-1]
        before = tokens[(at - 1) % len(tokens)]
        arc, found = singles.find(tokens[(at - 2) % len(tokens)] * self.words + before)
        out = self.begun[before]
        out[found] = singles.target[arc[found]]
        return out

    def walk(self, tokens: np.ndarray) -> np.ndarray:
        """The weight of each token's step."""
        out = np.empty(len(tokens))
        at = np.arange(0, len(tokens), LANE)
        state = self.reached(tokens, at)
        for _ in range(min(LANE, len(tokens))):
            at = at[at < len(tokens)]
            out[at], state = self.step(state[: len(at)], tokens[at])
            at = at + 1
        return out


def _automaton(b: Block, c: np.ndarray, t: np.ndarray, counts: dict[str, np.ndarray], v: int, n: int, alpha: float, discount: float) -> Automaton:
    """The part of the model that a block's n-grams reach, from their counts and those of the arcs of their histories; counts is emptied, so that little lies in memory twice."""
    root = np.log10(c + alpha) - math.log10(n + alpha * (v + 1))
    begun = np.where((c > 0) & (np.arange(len(c)) != b.end), 1 + np.arange(len(c)), 0)
    log = lambda mass: np.log10(np.where(mass > 0, mass, 1.0))
    left = discount * t / np.maximum(c, 1)
    pair_c, pair_t, triple_c = (counts.pop(k) for k in ("pair_c", "pair_t", "triple_c"))
    seen = np.flatnonzero(pair_c > 0)
    history, after, pair_c, pair_t = b.history[seen], b.next[seen], pair_c[seen], pair_t[seen]
    pair_p = np.maximum(pair_c - discount, 0) / c[history] + left[history] * 10.0 ** root[after]
    target = np.where(after == b.end, 0, 1 + len(c) + np.arange(len(seen))).astype(np.int32)
    singles = Level(1, b.pairs[seen], np.log10(pair_p), target, log(left), np.zeros(len(c), np.int32))
    left = discount * pair_t / pair_c
    del history, pair_t
    own = triple_c > 0
    state, last, triple_c = np.searchsorted(seen, b.state[own]).astype(np.int32), b.last[own], triple_c[own]
    del own, seen
    spans = [slice(i, i + FOUND) for i in range(0, len(state), FOUND)]
    shorter = np.concatenate([np.empty(0, np.int32), *(singles.find(after[state[s]].astype(np.int64) * len(c) + last[s])[0].astype(np.int32) for s in spans)])  # a triple's last two words are a training pair, too
    triple_p = np.maximum(triple_c - discount, 0) / pair_c[state] + left[state] * pair_p[shorter]
    del triple_c, pair_c, pair_p
    doubles = Level(1 + len(c), state.astype(np.int64) * len(c) + last, np.log10(triple_p, out=triple_p), target[shorter], log(left), 1 + after)
    return Automaton(len(c), root, begun, [doubles, singles])


def _walk(row: dict, answers: list[dict], parts: int, hot: Hot, arcs: np.ndarray, v: int, n: int, alpha: float, discount: float) -> tuple[np.ndarray, ...]:
    """(tokens, known tokens, base score, score) of each document of a block; arcs are those of the hot histories."""
    b, hot_at, words = Block.of(row, row["words"]), np.array(row["hot"], np.int64), len(hot.words)
    split = [parts, int(hot.first[words])]
    told: list[list[dict]] = [[], [], []]
    for r in sorted(answers, key=lambda r: r["part"]):
        told[int(np.searchsorted(split, r["part"], "right"))].append(r)
    of = lambda kind, name: _joined([r[name] for r in told[kind]]).astype(float)
    c, t = of(0, "c"), of(0, "t")
    t[hot_at[hot_at >= 0]] = arcs[:words][hot_at >= 0]
    hot_history, hot_pair, place = b.hot(hot, hot_at)
    counts = {"pair_c": np.empty(len(b.pairs)), "pair_t": np.empty(len(b.pairs)), "triple_c": np.empty(len(b.state))}
    for kind, mine in enumerate((~hot_history, hot_history)):
        for name in ("pair_c", "pair_t"):
            counts[name][mine] = of(kind, name)
        counts["triple_c"][(mine & ~hot_pair)[b.state]] = of(kind, "triple_c")
    counts["pair_t"][place[place >= 0]] = arcs[words:][place >= 0]
    counts["triple_c"][hot_pair[b.state]] = of(2, "triple_c")
    del told, b.pair_n  # what isn't read again would lie beside the automaton
    model = _automaton(b, c, t, counts, v, n, alpha, discount)
    alone = model.root[b.tokens]
    ends = b.starts + b.lengths
    base = np.array([math.fsum(alone[x:y].tolist()) for x, y in zip(b.starts.tolist(), ends.tolist())])
    return b.lengths, np.add.reduceat((c > 0)[b.tokens].astype(np.int64), b.starts), base, np.add.reduceat(model.walk(b.tokens), b.starts)


def score(docs: DataFrame, training: Column, doc: str = "doc_id", text: str = "text", alpha: float = ALPHA, discount: float = DISCOUNT) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score), one row for each row of docs.

    training: a boolean column, null counts as false. base_score is the unigram model's log10
    probability, score the automaton's; the probabilities of all known words and one unknown
    word sum to 1 in each state. Null and empty texts are an end token alone. Repeated rows are
    scored, and counted, one by one. Without training documents all words are unknown. An empty
    table gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = stored(encoded(docs, training, doc, text), "blocks")
    entries, size = blocks.agg(F.sum("entries"), F.sum("size")).first()
    parts = max(1, math.ceil((entries or 0) / PART_ENTRIES))
    heavy = blocks.select(F.explode("heavy").alias("h")).groupBy("h.word", "h.after").agg(F.sum("h.n").alias("n")).where(F.col("n") * 2 * HOT > (size or 0)).collect()  # at most 2 * HOT words and as many pairs
    hot_words = sorted((r.word % (1 << 64), r.n) for r in heavy if r.after is None)
    hot_pairs = sorted((r.word % (1 << 64), r.after % (1 << 64), r.n) for r in heavy if r.after is not None)
    shares = [math.ceil(2 * parts * h[-1] / size) for h in hot_words + hot_pairs]
    hot_names = np.array([h[0] for h in hot_words], np.uint64)
    hot = Hot(hot_names, np.searchsorted(hot_names, np.array([h[:2] for h in hot_pairs], np.uint64).reshape(-1, 2)), np.cumsum([parts, *shares]))
    names = ("block", "train", "lengths", "words", "tokens")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked = zip(*_requests({n: batch.column(n)[i].as_py() for n in names}, parts, hot))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(asked, [pa.int64()] * 2 + [pa.binary()] * len(_PACKED))], names=["part", "block", *_PACKED])
        tidy()

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        own = int(np.searchsorted(hot.first, key[0].as_py(), "right")) - 1
        out = _added(table, own, own >= len(hot.words))
        tidy()
        return out

    told = ("c", "t", "pair_c", "pair_t", "triple_c")
    binary = lambda columns: ", ".join(f"{x} binary" for x in columns)
    asked = blocks.select(*names).mapInArrow(ask, f"part long, block long, {binary(_PACKED)}")
    answers = stored(asked.groupBy("part").applyInArrow(answer, f"block long, part long, hot long, {binary(told)}, v long, n long, arcs long"), "answers")
    totals = answers.agg(F.sum("v"), F.sum("n")).first()
    v, n = totals[0] or 0, totals[1] or 0
    arcs = np.zeros(len(shares))
    for r in answers.where("hot >= 0").groupBy("hot").agg(F.sum("arcs").alias("arcs")).collect():  # as many rows as hot words and pairs
        arcs[r.hot] = r.arcs

    bare = ("block", "ids", "train", "lengths", "tokens")

    def without_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks as a walk needs them: the number of their words and the places of the hot ones."""
        for batch in batches:
            words = [unpacked_names(x) for x in batch.column("words").to_pylist()]
            columns = [*(batch.column(n) for n in bare), pa.array([len(w) for w in words], pa.int64()), pa.array([hot.places(w).tolist() for w in words], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*bare, "words", "hot"])
        tidy()

    def walk_block(key: tuple, block: pa.Table, answered: pa.Table) -> pa.Table:
        row = {k: block[k][0].as_py() for k in ("lengths", "tokens", "words", "hot")}
        lengths, known, base, total = _walk(row, answered.select(["part", *told]).to_pylist(), parts, hot, arcs, v, n, alpha, discount)
        out = pa.table({
            "doc_id": block["ids"].combine_chunks().flatten(), "train": block["train"].combine_chunks().flatten(), "n_tokens": lengths, "n_known": known,
            "train_tokens": np.full(len(lengths), n, np.int64), "base_score": base, "score": total,
        })
        tidy()
        return out

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc].dataType), *T.StructType.fromDDL("train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])
    placed = blocks.select(*bare, "words").mapInArrow(without_names, T.StructType([*blocks.select(*bare).schema.fields, *T.StructType.fromDDL("words long, hot array<long>").fields]))
    return placed.groupBy("block").cogroup(answers.select("block", "part", *told).groupBy("block")).applyInArrow(walk_block, schema)

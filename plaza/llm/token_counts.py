"""Token counts under a unigram model, by dynamic programming over a trie.

A pre-token is a word with the word mark before it. Distinct pre-tokens are inserted in a
trie whose nodes hold the best score of any segmentation of their prefix and its number of
tokens: both are computed once, when a node is made, and shared by all words with that
prefix. The count at a word's last node is kept for the word.

The vocabulary is that of a public tokenizer file; a piece's score is the Zipf logarithm of
its rank in the file. Characters that no piece covers become one token a byte.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_columns

MARK = "▁"
#: Nodes and words that a task remembers; beyond it starts anew, which changes no count.
MAX_NODES, MAX_WORDS = 300_000, 300_000
#: Longer pre-tokens are scored on the way, without nodes.
LONG_WORD = 256


def load_pieces(path: str) -> dict[str, float]:
    """piece -> score of a SentencePiece file's ordinary pieces, scores by rank: -log(rank) - log(sum of 1 / rank)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    norm = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -math.log(r) - norm for r, p in enumerate(pieces, 1)}


class TrieCounter:
    """Token counts of pre-tokens. Ties between segmentations go to the longer last piece."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        # a byte costs more than any piece, so that a character is only spelled out if it must be
        self.byte = min(pieces.values(), default=0.0) - 10.0
        # all ends of pieces, those that are no piece with a score that never wins: where text isn't one, no longer piece ends
        self.ends = dict.fromkeys((p[i:] for p in pieces for i in range(1, len(p))), -math.inf) | pieces
        self.clear()

    def clear(self) -> None:
        # children by node and character; per node: score and number of tokens of the prefix
        self.children: dict[int, int] = {}
        self.score = [0.0]
        self.tokens = [0]

    def _step(self, word: str, i: int, scores: list[float], counts: list[int]) -> tuple[float, int]:
        """Score and count of the first i characters; scores[-k] belongs to the prefix without its last k characters."""
        best, n, k, get = -math.inf, 0, 1, self.ends.get
        while k <= i and (own := get(word[i - k : i])) is not None:
            if (score := scores[-k] + own) >= best:
                best, n = score, counts[-k] + 1
            k += 1
        if word[i - 1] not in self.pieces:
            spelled = len(word[i - 1].encode("utf-8", "replace"))
            if scores[-1] + spelled * self.byte > best:
                best, n = scores[-1] + spelled * self.byte, counts[-1] + spelled
        return best, n

    def count(self, word: str) -> int:
        """Tokens of a pre-token."""
        return self._insert(word) if len(word) <= LONG_WORD else self._long(word)

    def _insert(self, word: str) -> int:
        if len(self.score) + len(word) > MAX_NODES:
            self.clear()
        children, known, tokens = self.children, self.score, self.tokens
        scores, counts, node = [0.0], [0], 0
        for i, c in enumerate(word, 1):
            key = node << 21 | ord(c)
            child = children.get(key)
            if child is None:
                children[key] = child = len(known)
                score, n = self._step(word, i, scores, counts)
                known.append(score)
                tokens.append(n)
            node = child
            scores.append(known[node])
            counts.append(tokens[node])
        return tokens[node]

    def _long(self, word: str) -> int:
        scores, counts = [0.0], [0]
        for i in range(1, len(word) + 1):
            score, n = self._step(word, i, scores, counts)
            scores.append(score)
            counts.append(n)
            if len(scores) > 2 * self.longest:
                del scores[: -self.longest], counts[: -self.longest]
        return counts[-1]


def count_tokens(docs: DataFrame, pieces: dict[str, float], text: str = "text") -> DataFrame:
    """docs with n_pretokens and n_tokens; existing columns of these names are replaced.

    Null, empty and blank texts have 0 of both. Each row is counted alone from its whole text;
    words are runs of characters other than ASCII white space.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # a vocabulary file, of fixed size
    made: list[TrieCounter] = []
    seen: dict[bytes, int] = {}

    def run(texts: list[bytes]) -> list[pa.Array]:
        if not made:
            made.append(TrieCounter(shared.value))
        count = made[0].count
        n, total = [], []
        for raw in texts:
            words = raw.split()
            if len(seen) >= MAX_WORDS:
                seen.clear()
            new = {w for w in set(words) if w not in seen}
            long = {w: count(MARK + w.decode("utf-8", "replace")) for w in new if len(w) > LONG_WORD}
            seen.update((w, count(MARK + w.decode("utf-8", "replace"))) for w in new if len(w) <= LONG_WORD)
            n.append(len(words))
            total.append(sum(long[w] if w in long else seen[w] for w in words) if long else sum(map(seen.__getitem__, words)))
        return [pa.array(n, pa.int64()), pa.array(total, pa.int64())]

    return with_columns(docs, text, [T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())], run)

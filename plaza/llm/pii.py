"""Personal data by weak supervision.

Labelers of three sorts (regular expressions with checksums, gazetteers, context words) vote
on candidate spans: +1, -1 or nothing. Expectation-maximisation estimates from the vote
patterns of all documents how reliable each labeler is for each kind, and the posterior of
each pattern; a logistic classifier on votes and shape is then trained on these soft labels
and decides on every candidate. Spans of the base rules stay whatever it decides; candidates
beyond them that it accepts are added.

What the corpus is reduced to for training are counts by pattern, of which there are at most
``len(KINDS) * 3 ** LABELERS * SHAPES``, however many documents there are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, slices, with_columns

#: Kinds in the order in which spans of one start are listed; the first four have base rules.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
#: Votes of a candidate: rule, checksum, gazetteer, context before, context after.
LABELERS = 5
#: Shapes that the classifier sees besides the votes.
SHAPES = 8
ROUNDS = 60
#: A candidate beyond the base rules is added at this probability.
ACCEPT = 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{20,}+={0,2}(?![A-Za-z0-9_+/=-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")
_SPACED_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)+", re.IGNORECASE)
_AT = re.compile(r"[(\[]at[)\]]", re.IGNORECASE)
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[^0-9]+")

#: P(vote -1, 0, 1 | class 0 and 1) that EM starts from: shape labelers, then the context before and after.
START = np.array([[[0.5, 0.35, 0.15], [0.1, 0.3, 0.6]]] * 3 + [[[0.45, 0.5, 0.05], [0.01, 0.39, 0.6]], [[0.2, 0.75, 0.05], [0.1, 0.7, 0.2]]])

# Gazetteers and context words.
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "int", "mil", "info", "io", "biz", "de", "fr", "es", "uk", "it", "nl", "eu", "cn", "jp", "ru", "ch", "at", "us", "ca", "au", "br", "in", "test", "example"}
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "351", "352", "353", "358", "380", "420", "852", "886", "966", "971", "972")
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38", "62")
SECRET_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "glpat-", "sk-", "sk_live_", "pk_live_", "xoxb-", "xoxp-", "AIza", "eyJ")
BEFORE = {
    "email": ("mail", "e-mail", "email", "contact", "write", "reach", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "address", "addr", "ping", "ssh", "from", "client"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "pan", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "telefono", "whatsapp", "contact"),
    "secret": ("token", "secret", "key", "password", "passwd", "apikey", "api_key", "bearer", "auth", "credential"),
}
AGAINST = ("version", "isbn", "order", "page", "pages", "section", "figure", "table", "checksum", "sha", "sha1", "sha256", "md5", "commit", "hash", "uuid")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return _DIGITS.sub("", text)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; linear in the text, for the run before each @ is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def numbers(text: str) -> Iterator[tuple[str, int, int]]:
    """ip, card and phone matches, valid or not."""
    for kind, rule in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in rule.finditer(text):
            yield kind, m.start(), m.end()


def valid(kind: str, match: str) -> bool:
    if kind == "ip":
        return all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in match.split("."))
    digits = _digits(match)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the base rules, by start and kind."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [(k, a, b) for k, a, b in numbers(text) if valid(k, text[a:b])]
    return ordered(out)


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """Base spans (True) and further candidates that don't touch them or an earlier candidate."""
    base = [("email", a, b) for a, b in emails(text)]
    loose: list[tuple[str, int, int]] = []
    for k, a, b in numbers(text):
        if valid(k, text[a:b]):
            base.append((k, a, b))
        elif k != "phone" and 8 <= len(_digits(text[a:b])) <= 24:
            loose.append((k, a, b))
    if _AT.search(text):
        loose += [("email", m.start(), m.end()) for m in _SPACED_EMAIL.finditer(text)]
    if _DIGIT.search(text) or any(p in text for p in SECRET_PREFIXES):
        loose += [("phone", m.start(), m.end()) for m in _LOCAL_PHONE.finditer(text)]
        loose += [("secret", m.start(), m.end()) for m in _SECRET.finditer(text) if _looks_random(m.group())]
    taken = sorted((a, b) for _, a, b in base)
    out = [(*s, True) for s in base]
    starts = np.array([a for a, _ in taken] + [len(text) + 1])
    ends = np.maximum.accumulate(np.array([b for _, b in taken])) if taken else np.empty(0, int)
    last = 0
    for k, a, b in ordered(loose):
        i = int(np.searchsorted(starts, b))  # base spans that start before b
        if a >= last and (not i or ends[i - 1] <= a):
            out.append((k, a, b, False))
            last = b
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _looks_random(word: str) -> bool:
    digits = sum(c.isdigit() for c in word)
    return digits >= 3 and len(word) - digits >= 3 or word.startswith(SECRET_PREFIXES)


def _near(text: str, a: int, b: int) -> tuple[list[str], list[str]]:
    before = re.split(r"[^a-z0-9_-]+", text[max(0, a - 32) : a].lower())
    after = re.split(r"[^a-z0-9_-]+", text[b : b + 16].lower())
    return [w.strip("-_") for w in before if w], [w.strip("-_") for w in after if w]


def pattern(text: str, kind: str, a: int, b: int) -> tuple:
    """(kind, votes..., shape) of a candidate: all that training and deciding look at."""
    match = text[a:b]
    digits = _digits(match)
    if kind == "email":
        strict = "@" in match
        rule, check = (1 if strict else 0), (1 if strict and ".." not in match and not match.startswith(".") else -1)
        gazetteer = 1 if re.split(r"[.\s)\]]+", match)[-1].lower() in TOP_DOMAINS else -1
    elif kind == "ip":
        ok = valid(kind, match)
        rule, check = (1 if ok else -1), (1 if ok and not any(len(p) > 1 and p[0] == "0" for p in match.split(".")) else -1)
        gazetteer = -1 if match.startswith(("0.", "255.")) else 0
    elif kind == "card":
        rule = 1 if 14 <= len(digits) <= 19 else -1
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_PREFIXES) and len(digits) in (14, 15, 16, 19) else -1
    elif kind == "phone":
        rule, check = (1 if match[0] == "+" else 0), (1 if 10 <= len(digits) <= 15 else -1)
        gazetteer = (1 if digits.startswith(CALLING_CODES) else -1) if match[0] == "+" else 0
    else:
        rule = 1 if re.search(r"[=:]\s?[\"']?$", text[max(0, a - 4) : a]) else 0  # the value of an assignment
        check = -1 if len(set(match)) < 10 else 1 if len(match) >= 32 else 0
        gazetteer = 1 if match.startswith(SECRET_PREFIXES) else 0
    before, after = _near(text, a, b)
    context = 1 if any(w in BEFORE[kind] for w in before[-4:]) else -1 if any(w in AGAINST for w in before[-3:]) else 0
    later = 1 if kind != "email" and any(w in BEFORE[kind] for w in after[:2]) else 0
    shape = (len(digits) * 2 >= len(match)) + 2 * (len(set(digits)) > 3) + 4 * (b - a > 24)
    return kind, rule, check, gazetteer, context, later, int(shape)


def pattern_counts(docs: DataFrame, text: str = "text") -> Counter:
    """How often each pattern occurs over all documents; its size is bounded by the number of patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in slices(batches):
            for t in part.column(0).to_pylist():
                if t:
                    seen.update(pattern(t, k, a, b) for k, a, b, _ in candidates(t))
        keys = [",".join(map(str, k)) for k in seen]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(seen.values()), pa.int64())], names=["key", "n"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(text).mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    out: Counter = Counter()
    for r in rows:
        kind, *rest = r.key.split(",")
        out[(kind, *map(int, rest))] = r.n
    return out


def reliabilities(counts: Counter, rounds: int = ROUNDS) -> tuple[dict[str, np.ndarray], dict[tuple, float]]:
    """EM over vote patterns. Per kind: P(vote | class) of each labeler, as [labeler, class, vote + 1]; and the posterior of each pattern.

    Starts from START and a prior of one half, with pseudo-counts of START that keep every
    reliability inside (0, 1) and the classes in their places: without candidates the start
    values stay. The order of patterns doesn't matter.
    """
    tables: dict[str, np.ndarray] = {}
    posterior: dict[tuple, float] = {}
    for kind in KINDS:
        keys = sorted(k for k in counts if k[0] == kind)
        theta = START.copy()
        prior = 0.5
        if keys:
            votes = np.array([k[1 : 1 + LABELERS] for k in keys]) + 1
            n = np.array([counts[k] for k in keys], float)
            pseudo = START * max(1.0, 0.05 * n.sum())
            for _ in range(rounds):
                logs = np.log(theta[np.arange(LABELERS), :, votes]).sum(1) + np.log([1 - prior, prior])
                p = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
                w = np.stack([n * (1 - p), n * p])
                prior = float((w[1].sum() + 1) / (n.sum() + 2))
                for j in range(LABELERS):
                    for v in range(3):
                        theta[j, :, v] = w[:, votes[:, j] == v].sum(1) + pseudo[j, :, v]
                theta /= theta.sum(2, keepdims=True)
            posterior.update(zip(keys, p.tolist()))
        tables[kind] = theta
    return tables, posterior


def _features(key: tuple) -> np.ndarray:
    x = np.zeros(len(KINDS) + 3 * LABELERS + 3)
    x[KINDS.index(key[0])] = 1
    for j, v in enumerate(key[1 : 1 + LABELERS]):
        x[len(KINDS) + 3 * j + v + 1] = 1
    for j in range(3):
        x[len(KINDS) + 3 * LABELERS + j] = key[-1] >> j & 1
    return x


def train_classifier(counts: Counter, posterior: dict[tuple, float], steps: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic classifier on the soft labels of all candidates (Newton steps, ridge-regularised); zeros without candidates."""
    keys = sorted(counts)
    weights = np.zeros(len(KINDS) + 3 * LABELERS + 3)
    if not keys:
        return weights
    x = np.array([_features(k) for k in keys])
    y = np.array([posterior[k] for k in keys])
    n = np.array([counts[k] for k in keys], float)
    n /= n.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (p - y)) + ridge / len(keys) * weights
        hessian = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge / len(keys) * np.eye(len(weights))
        weights -= np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return weights


class Model:
    """Labeler reliabilities and classifier weights."""

    def __init__(self, tables: dict[str, np.ndarray], weights: np.ndarray) -> None:
        self.tables, self.weights = tables, weights
        self.known: dict[tuple, float] = {}

    def probability(self, key: tuple) -> float:
        if key not in self.known:
            self.known[key] = float(1 / (1 + np.exp(-np.clip(_features(key) @ self.weights, -30, 30))))
        return self.known[key]

    def spans(self, text: str, accept: float = ACCEPT) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """(base spans, all spans) of a text, in code points."""
        found = candidates(text)
        return [s[:3] for s in found if s[3]], [(k, a, b) for k, a, b, base in found if base or self.probability(pattern(text, k, a, b)) >= accept]


def train(docs: DataFrame, text: str = "text") -> Model:
    """The model from the candidates of all documents."""
    counts = pattern_counts(docs, text)
    tables, posterior = reliabilities(counts)
    return Model(tables, train_classifier(counts, posterior))


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with pii_base and pii_spans, arrays of (kind, start, end) in code points; existing columns of these names are replaced.

    Null and empty texts have no spans. Each row is judged alone, repeated rows alike. Long
    texts are searched whole, in time linear in their length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes]) -> list[pa.Array]:
        both = [shared.value.spans(t.decode("utf-8", "replace")) for t in texts]
        return [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in x[i]] for x in both], _ARROW_SPAN) for i in (0, 1)]

    return with_columns(docs, text, [T.StructField("pii_base", SPAN), T.StructField("pii_spans", SPAN)], run)


def mask(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with each span of its texts replaced by its kind in angle brackets; where spans overlap, the first and then the longest counts. Null stays null; all other columns stay."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for t in part.column(at).to_pylist():
                done, pieces = 0, []
                for kind, a, b in sorted(shared.value.spans(t)[1], key=lambda s: (s[1], -s[2], s[0])) if t else ():
                    if a >= done:
                        pieces += [t[done:a], f"<{kind}>"]
                        done = b
                out.append("".join([*pieces, t[done:]]) if t is not None else None)
            columns = list(part.columns)
            columns[at] = pa.array(out, part.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)

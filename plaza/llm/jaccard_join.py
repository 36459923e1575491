"""Exact n-gram Jaccard self-join of documents by signature trees.

A document is the set of its distinct five-word shingles, two documents link when
100 * intersection >= 75 * union. Every link is found:

1. Screen. At most 25 % of a set of n is foreign to a partner, so in any global order the
   first k common shingles of two linked sets lie in the first 25 % of n, plus k, of each.
   With k = ``SCREEN`` less 25 % of the smaller set: a document can have a link only if that
   many of its least shingles (in hash order) are also among another document's. Texts are
   shingled once for it, into blocks that ask for document frequencies by packed requests
   (``asking``); documents that don't pass are alone.
2. Prefix. Of those k common shingles one lies, in order of frequency, before the last k of
   either document's: linked documents share a shingle of this prefix.
3. Documents with equal sets become one class with a multiplicity.
4. Classes are dealt to runs of about ``RUN`` shingles by their least shared shingle, which
   similar sets mostly have in common; a crowded run is dealt to several. A class is compared
   with its own run, and with each other run where a shingle of its prefix occurs: only
   classes that share one go into the task of a pair of runs.
5. In a task, tokens of a single set are left out, and signature trees over both sides are
   traversed together: a node has the OR of its members' token bitmaps, its range of sizes and
   its most bit collisions, and a pair of nodes goes if the largest possible overlap is too
   small. Pairs of leaf nodes that stay are counted exactly, a leaf against all its partners.
6. Tasks return link counts and a spanning forest of the links, not the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .asking import answered, together
from .common import bounded_batches, discard, distinct, lists, packed, packed_names, raw_texts, slices, spread_join, stored, tidy, unpacked, unpacked_names, windows, without_rows, word_hashes
from .components import components

WORDS = 5
#: Similarity as hundredths of the union.
PERCENT = 75
#: Share of a set, in hundredths, that the screen looks at. The more, the less do passages that many documents share bring into prefixes.
SCREEN = 50
#: Shingles to a run, where each class counts as RUN_ROW more.
RUN, RUN_ROW = 1 << 20, 1 << 7
#: Runs that one least shingle is dealt to at most have numbers below this.
RUNS_OF_ONE = 1 << 20
#: Shingles of the screen in a block, about.
BLOCK_SHINGLES = 600_000
#: Slots of the bit filter for ids, whatever the input's size.
FILTER_SLOTS = 1 << 23
#: Members of a leaf node, children of a node, partners of a leaf that are counted at a time.
LEAF, FANOUT, PARTNERS = 16, 4, 1024


def shingles_of(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; the whole sequence if there are fewer words, none without words."""
    w = raw.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    return distinct(windows(word_hashes(w), min(words, len(w))))


def _needed(n: int, percent: int) -> int:
    """The least size of a partner of a set of n, and of their overlap."""
    return -(-n * percent // 100)


def _surplus(n: int, percent: int) -> int:
    """How many common shingles a set of n is screened for."""
    return max(1, n * (SCREEN - 100 + percent) // 100)


def _taken(n: int, percent: int) -> int:
    """How many of its least shingles a set of n is screened by."""
    least_partner = _needed(n, percent)
    return min(n, n - least_partner + _surplus(n, percent))


# --- the screen ---


def _block(name: int, rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    """One row: documents with sizes and digests of their sets, and the least shingles of each."""
    ids, keys, sizes, digests, least = zip(*rows)
    d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    flat = np.concatenate(least)
    names, n = np.unique(flat, return_counts=True)
    columns = [
        pa.array([name], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([keys], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([d[:, 0]], pa.list_(pa.int64())), pa.array([d[:, 1]], pa.list_(pa.int64())),
        pa.array([packed_names(flat)], pa.binary()), pa.array([packed(np.array([len(x) for x in least]))], pa.binary()), pa.array([packed_names(names)], pa.binary()), pa.array([packed(n)], pa.binary()), pa.array([len(names)], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "keys", "sizes", "d1", "d2", "least", "taken", "names", "n", "entries"])


def sketched(docs: DataFrame, doc: str, text: str, words: int, percent: int) -> DataFrame:
    """One row for each block of documents, made where they are read. keys are hashes of the texts; rows with a null id have no least shingles."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, held, id_type = TaskContext.get().partitionId() << 32, 0, [], None
        for part in slices(batches):
            id_type = part.column(0).type
            for own, key, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), raw_texts(part.column(2))):
                s = shingles_of(raw, words)
                least = s[: _taken(len(s), percent) if own is not None else 0].copy()
                held.append((own, key, len(s), xxhash.xxh3_128_digest(s.tobytes()), least))
                size += len(least) + 16
                if size >= BLOCK_SHINGLES:
                    yield _block(name, held, id_type)
                    name, size, held = name + 1, 0, []
        if held:
            yield _block(name, held, id_type)
        del held
        tidy()  # once more: the last block came after the slices

    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[doc].dataType))]
        + T.StructType.fromDDL("keys array<long>, sizes array<long>, d1 array<long>, d2 array<long>, least binary, taken binary, names binary, n binary, entries long").fields
    )
    bounded_batches(docs.sparkSession)
    return rows.mapInArrow(run, schema)


def screened(blocks: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """What the blocks were answered, and (doc_id, d1, d2, home, prefix) of the documents that may have links: their least shared shingle, and their rarest shared ones."""
    answers = answered(blocks, ["n"], lambda inverse, size, told: np.bincount(inverse, told[0], size)[inverse])

    def judge(_: tuple, block: pa.Table, answers_: pa.Table) -> pa.Table:
        least = unpacked_names(block["least"][0].as_py())
        df = together(answers_)[np.unique(least, return_inverse=True)[1]]
        ids, sizes, d1, d2 = (block[c].combine_chunks().flatten() for c in ("ids", "sizes", "d1", "d2"))
        rows, home, prefix, at = [], [], [], 0
        for i, (size, taken) in enumerate(zip(sizes.to_pylist(), unpacked(block["taken"][0].as_py()).tolist())):
            own, often = least[at : at + taken], df[at : at + taken]
            at += taken
            shared = own[often > 1]
            need = _surplus(_needed(size, percent), percent)
            if len(shared) >= need and taken:
                rows.append(i)
                home.append(shared[0])
                prefix.append(shared[np.lexsort((shared, often[often > 1]))][: len(shared) - need + 1].view(np.int64))
        out = pa.table({"doc_id": ids.take(pa.array(rows, pa.int64())).cast(pa.int64()), "d1": d1.take(pa.array(rows, pa.int64())), "d2": d2.take(pa.array(rows, pa.int64())), "home": pa.array(np.array(home, np.uint64).view(np.int64)), "prefix": lists(prefix, pa.int64())})
        tidy()
        return out

    needed = blocks.select("block", "ids", "sizes", "d1", "d2", "least", "taken")
    return answers, needed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, "doc_id long, d1 long, d2 long, home long, prefix array<long>")


def sets_of(docs: DataFrame, ids: DataFrame, doc: str, text: str, words: int) -> DataFrame:
    """(rep, d1, d2, shingles) of the documents in ids(rep), and of a few others: ids are looked up in a bit filter of fixed size."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_SLOTS)).cast("int")
    taken = np.zeros(FILTER_SLOTS, bool)
    taken[ids.select(slot(F.col("rep")).alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True  # at most FILTER_SLOTS
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(taken))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.unpackbits(bits.value).view(bool)
        for part in slices(batch.filter(pa.array(own[batch.column(1).to_numpy()])) for batch in batches):
            found = [shingles_of(raw, words) for raw in raw_texts(part.column(2))]
            d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(d[:, 0]), pa.array(d[:, 1]), lists([s.view(np.int64) for s in found], pa.int64())], names=["rep", "d1", "d2", "shingles"])

    own_id = F.col(doc).cast("long")
    return docs.where(F.col(doc).isNotNull()).select(own_id.alias("rep"), slot(own_id).alias("slot"), F.col(text).alias("text")).mapInArrow(run, "rep long, d1 long, d2 long, shingles array<long>")


# --- inside a task ---


class Side:
    """Sets of tokens, given as numbers, and their sizes before tokens of a single set were left out."""

    def __init__(self, tokens: list[np.ndarray], sizes: np.ndarray) -> None:
        self.tokens, self.sizes = tokens, sizes

    def __len__(self) -> int:
        return len(self.tokens)


def sides(a: list[np.ndarray], b: list[np.ndarray] | None) -> tuple[Side, Side, int]:
    """Both sides with their tokens numbered, and how many numbers there are; tokens that only one set has get none. b is null for a run with itself."""
    all_ = [*a, *(b or ())]
    tokens, number, n = np.unique(np.concatenate(all_), return_inverse=True, return_counts=True)
    renumbered = np.where(n > 1, np.cumsum(n > 1) - 1, -1)[number]
    parts = np.split(renumbered, np.cumsum([len(s) for s in all_])[:-1])
    left = [p[p >= 0] for p in parts]
    sizes = np.array([len(s) for s in all_], np.int64)
    first = Side(left[: len(a)], sizes[: len(a)])
    return first, first if b is None else Side(left[len(a) :], sizes[len(a) :]), int((n > 1).sum())


class Tree:
    """A signature tree over the sets of a side in their order, as arrays by level; level 0 are runs of LEAF sets.

    Of a node: its members' range, their range of sizes, the OR of their bitmaps, and the most tokens beyond the first on a bit that any has.
    """

    def __init__(self, side: Side, bits: int) -> None:
        rows = []
        for a in range(0, len(side), LEAF):
            z = min(a + LEAF, len(side))
            own, spare = np.zeros(bits, bool), 0
            for s in side.tokens[a:z]:
                on = distinct(s % bits)
                own[on] = True
                spare = max(spare, len(s) - len(on))
            rows.append((a, z, int(side.sizes[a:z].min()), int(side.sizes[a:z].max()), np.packbits(own).view(np.uint64), spare))
        self.levels = [rows]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            groups = [below[i : i + FANOUT] for i in range(0, len(below), FANOUT)]
            self.levels.append([(g[0][0], g[-1][1], min(x[2] for x in g), max(x[3] for x in g), np.bitwise_or.reduce([x[4] for x in g]), max(x[5] for x in g)) for g in groups])

    def children(self, level: int, i: int) -> range:
        return range(i * FANOUT, min((i + 1) * FANOUT, len(self.levels[level - 1])))


def bits_for(side: Side, tokens: int) -> int:
    """Bits of a signature: a power of two with room for the tokens of a leaf of unlike sets, so that the OR of a leaf stays sparse."""
    mean = sum(map(len, side.tokens)) / max(1, len(side))
    return 1 << min(max(9, math.ceil(math.log2(max(1, min(tokens, 4 * LEAF * mean))))), 16)


def sizes_allow(x: tuple, y: tuple, percent: int) -> bool:
    """Whether any pair under two nodes can link by its sizes."""
    return 100 * x[3] >= percent * y[2] and 100 * y[3] >= percent * x[2]


def signatures_allow(x: tuple, y: tuple, percent: int) -> bool:
    """Whether any pair under two nodes can overlap enough: as often as both have a bit, and once more for each token beyond the first on a bit."""
    most = min(x[3], y[3], int(np.bitwise_count(x[4] & y[4]).sum()) + min(x[5], y[5]))
    return most * (100 + percent) >= percent * (x[2] + y[2])


def traverse(a: Tree, b: Tree, same: bool, percent: int) -> Iterator[tuple[int, int]]:
    """The pairs of leaf nodes that may hold links, as their numbers; each once."""
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        x, y = a.levels[la][i], b.levels[lb][j]
        if same and x[0] >= y[1] or not sizes_allow(x, y, percent) or not signatures_allow(x, y, percent):
            continue
        if la == lb == 0:
            yield i, j
        elif la >= lb:
            stack += [(la - 1, k, lb, j) for k in a.children(la, i)]
        else:
            stack += [(la, i, lb - 1, k) for k in b.children(lb, j)]


def overlaps(a: list[np.ndarray], b: list[np.ndarray], place: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of all sets of a with all of b, through the tokens of a. place has -1 for each token, before and after."""
    own = distinct(np.concatenate(a))
    place[own] = np.arange(len(own))
    out = np.zeros((len(a), len(b)), np.float32)
    rows = [(np.repeat(np.arange(len(x)), [len(s) for s in x]), place[np.concatenate(x)]) for x in (a, b)]
    for at in range(0, len(own), 4096):
        wide = min(4096, len(own) - at)
        ma, mb = np.zeros((len(a), wide), np.float32), np.zeros((len(b), wide), np.float32)
        for m, (r, c) in zip((ma, mb), rows):
            here = (c >= at) & (c < at + wide)
            m[r[here], c[here] - at] = 1
        out += ma @ mb.T
    place[own] = -1
    return out


def link_runs(a: list[np.ndarray], copies_a: np.ndarray, b: list[np.ndarray] | None, copies_b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of the sets of a with those of b, or with each other if b is null.

    (for each set of a the documents it links with, the same for b, pairs of sets that span the links' components). Sets of b are numbered after those of a.
    """
    same = b is None
    left, right, tokens = sides(a, b)
    bits = max(bits_for(left, tokens), bits_for(right, tokens))
    tree_a = Tree(left, bits)
    tree_b = tree_a if same else Tree(right, bits)
    partners: dict[int, list[int]] = {}
    for i, j in traverse(tree_a, tree_b, same, percent):
        partners.setdefault(i, []).append(j)
    linked_a, linked_b = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    offset = 0 if same else len(left)
    label = np.arange(len(left) + (0 if same else len(right)))
    edges: list[tuple[int, int]] = []
    place = np.full(tokens, -1)
    for i, own in partners.items():
        a0, a1 = tree_a.levels[0][i][:2]
        mine = np.arange(a0, a1)
        for k in range(0, len(own), PARTNERS // LEAF):
            theirs = np.concatenate([np.arange(*tree_b.levels[0][j][:2]) for j in sorted(own)[k : k + PARTNERS // LEAF]])
            both = overlaps(left.tokens[a0:a1], [right.tokens[j] for j in theirs.tolist()], place)
            hit = both * (100 + percent) >= percent * (left.sizes[a0:a1, None] + right.sizes[None, theirs])
            if same:
                hit &= theirs[None] > mine[:, None]
            linked_a[mine] += hit @ copies_b[theirs]
            linked_b[theirs] += copies_a[mine] @ hit
            while (apart := hit & (label[mine][:, None] != label[theirs + offset][None])).any():  # each turn joins two trees
                x, y = divmod(int(apart.argmax()), len(theirs))
                u, v = int(mine[x]), int(theirs[y]) + offset
                edges.append((u, v))
                label[label == label[v]] = label[u]
    return linked_a, linked_b, edges


# --- the join ---


def _solve(table: pa.Table, percent: int) -> pa.Table:
    """(u, v, n): of all tasks in a table, links of classes (v null) and edges of the forests (n 0)."""
    names = ("run_a", "run_b", "run", "home", "n", "cls", "copies")
    columns = {c: table[c].to_numpy() for c in names}
    shingles = table["shingles"].combine_chunks()
    flat, offsets = shingles.values.to_numpy().view(np.uint64), shingles.offsets.to_numpy()
    order = np.lexsort([columns[c] for c in reversed(names)])
    task = np.stack([columns["run_a"], columns["run_b"]])[:, order]
    us, vs, ns = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for rows in np.split(order, np.flatnonzero((np.diff(task) != 0).any(0)) + 1):
        cls, run = columns["cls"][rows], columns["run"][rows]
        fresh = np.append(True, (np.diff(cls) != 0) | (np.diff(run) != 0)) if len(rows) else []  # a class that came twice counts once
        rows, cls, run = rows[fresh], cls[fresh], run[fresh]
        if not len(rows):
            continue
        in_a = run == columns["run_a"][rows[0]]
        same = columns["run_a"][rows[0]] == columns["run_b"][rows[0]]
        sets_ = [flat[offsets[r] : offsets[r + 1]] for r in rows.tolist()]
        cut = int(in_a.sum())  # rows of run_a come first if it is the lesser one, as it is
        if len(rows) < 2 or not same and cut in (0, len(rows)):
            continue
        copies = columns["copies"][rows]
        n_a, n_b, edges = link_runs(sets_, copies, None, copies, percent) if same else link_runs(sets_[:cut], copies[:cut], sets_[cut:], copies[cut:], percent)
        n = n_a + n_b if same else np.concatenate([n_a, n_b])
        some = n > 0
        us += [cls[some], cls[[e[0] for e in edges]]]
        vs += [np.zeros(some.sum(), np.int64), cls[[e[1] for e in edges]]]
        ns += [n[some], np.zeros(len(edges), np.int64)]
    u, v, n = map(np.concatenate, (us, vs, ns))
    return pa.table({"u": u, "v": pa.array(v, mask=n > 0), "n": n})


def _classes_linked(docs: DataFrame, doc: str, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n, d1, d2) of each row, and (d1, d2, component_id, n_links, stays, n) of each class of equal sets that has a link or a copy; n are its documents."""
    spark = docs.sparkSession
    blocks = stored(sketched(docs, doc, text, words, percent), "sketches")
    rows = stored(blocks.select(F.explode(F.arrays_zip("ids", "keys", "sizes", "d1", "d2")).alias("r")).select(F.col("r.ids").alias("doc_id"), F.col("r.keys").alias("key"), F.col("r.sizes").alias("n"), "r.d1", "r.d2"), "rows")
    same = rows.where("n > 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "n", "d1", "d2").distinct()
    classes = same.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).withColumn("cls", F.xxhash64("d1", "d2"))
    # runs: by the least shared shingle, and by the class where one run would be too large
    answers, passed = screened(blocks, percent)
    placed = stored(passed.withColumnRenamed("doc_id", "rep").join(classes, ["rep", "d1", "d2"]), "placed")
    discard(blocks, answers)
    weight = F.col("n") + RUN_ROW
    total = placed.agg(F.sum(weight)).first()[0] or 0
    spread = F.pmod(F.col("home"), F.lit(max(1, math.ceil(total / RUN))))
    crowd = placed.groupBy(spread.alias("spot")).agg(F.ceil(F.sum(weight) / (2 * RUN)).alias("among"))
    dealt = placed.join(crowd, spread == F.col("spot")).withColumn("run", F.col("spot") * RUNS_OF_ONE + F.pmod(F.xxhash64("cls"), F.col("among")))
    dealt = stored(dealt.select("cls", "d1", "d2", "rep", "copies", "n", "home", "run", "prefix"), "dealt")
    discard(placed)
    # which runs a shingle of the prefix occurs in: near copies mostly have the same ones, so that lists of runs are few
    tokens = dealt.select("cls", "run", F.explode("prefix").alias("h"))
    held = tokens.groupBy("h").agg(F.min("cls").alias("least"), F.max("cls").alias("most"), F.sort_array(F.collect_set("run")).alias("runs")).where("least <> most")
    lists_ = F.xxhash64("runs")
    meets = stored(tokens.join(held.select("h", lists_.alias("list")), "h").select("cls", "run", "list").distinct(), "meets")
    runs = stored(held.select(lists_.alias("list"), "runs").distinct(), "lists")
    abroad = meets.join(runs.where(F.size("runs") > 1), "list").select("cls", "run", F.explode(F.array_remove("runs", F.col("run"))).alias("other"))
    pairs = meets.select("cls", "run", F.col("run").alias("other")).unionByName(abroad).distinct()
    part = pairs.select("cls", "run", F.least("run", "other").alias("run_a"), F.greatest("run", "other").alias("run_b"))
    sides_ = stored(part.join(dealt.drop("prefix", "run"), "cls"), "sides")
    tasks = max(1, math.ceil((sides_.agg(F.sum(weight)).first()[0] or 0) / (2 * RUN)))
    group = F.pmod(F.xxhash64("run_a", "run_b"), F.lit(tasks)).alias("task")
    work = sets_of(docs, sides_, doc, text, words).join(sides_, ["rep", "d1", "d2"]).select(group, "run_a", "run_b", "run", "home", "n", "cls", "copies", "shingles")

    def solve(_: tuple, table: pa.Table) -> pa.Table:
        out = _solve(table, percent)
        tidy()
        return out

    found = stored(work.groupBy("task").applyInArrow(solve, "u long, v long, n long"), "links")
    discard(dealt, meets, runs, sides_)
    # components of classes, named by the least id in them
    labels = components(found.where("v is not null").select("u", "v")).withColumnRenamed("node", "cls")
    counts = found.where("v is null").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("others"))
    of_class = classes.join(labels, "cls", "left").join(counts, "cls", "left").where("label is not null or copies > 1").withColumn("label", F.coalesce("label", "cls"))
    least = of_class.groupBy("label").agg(F.min(F.struct("rep", "d1", "d2")).alias("first"), F.count("*").alias("n"))
    stays = (F.col("d1") == F.col("first.d1")) & (F.col("d2") == F.col("first.d2"))
    answers = spread_join(of_class.drop("n"), least, ["label"], "cls")
    return rows, answers.select("d1", "d2", F.col("first.rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), stays.alias("stays"), F.col("copies").alias("n"))


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of each document.

    component_id is the least id reachable over links, the own id without links; n_links
    counts the documents linked directly. Documents without words (null, empty) have no
    shingles and no links. Ids must be integers. Each row is answered for its own text: rows
    that repeat id and text are one document and get equal answers, rows that share an id but
    not the text are linked as documents of their own (two with equal sets are one); rows with
    a null id keep a null component and no links. Other columns aren't read. An empty table
    gives no rows.
    """
    rows, answers = _classes_linked(docs, doc, text, words, percent)
    joined = spread_join(rows, answers, ["d1", "d2"], "doc_id", "left")
    has = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(has, F.coalesce("component_id", F.col("doc_id").cast("long"))).otherwise(F.col("doc_id").cast("long")).alias("component_id"),
        F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
    )


def keep_first(docs: DataFrame, doc: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """docs without the near duplicates of an earlier document: of each component, the rows with its least id and, if they differ, one of their texts.

    Rows are told apart by id and text: a text that shares its id with a near duplicate stays.
    Rows that repeat a document that stays, stay; so do those with a null id or without words.
    """
    rows, answers = _classes_linked(docs, doc, text, **({"words": WORDS, "percent": PERCENT} | parameters))
    gone = spread_join(rows.where("n > 0 and doc_id is not null"), answers, ["d1", "d2"], "doc_id").where(~F.col("stays") | (F.col("doc_id") != F.col("component_id")))
    return without_rows(docs, stored(gone.select(F.col("doc_id").alias("id"), "key").distinct(), "gone"), doc, text)

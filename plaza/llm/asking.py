"""Totals over a corpus for the things that blocks of documents hold, by packed requests.

A block lists its distinct things by 64-bit name, in ascending order, with numbers about each.
Names are dealt to parts by their range; a block sends each part one row, the part puts what
it got together and answers each block in the order of its request, so that answers need no
names. A thing costs a part one entry for each block that has it, however often it occurs.
There are never more rows than entries, and a part has about ``PART_ENTRIES`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounds, packed, packed_count, packed_names, stored, tidy, unpacked, unpacked_names

PART_ENTRIES = 1_500_000

#: (place of each entry's name among the part's distinct names, how many these are, the numbers told) -> one answer an entry.
Answer = Callable[[np.ndarray, int, list[np.ndarray]], np.ndarray]


def answered(blocks: DataFrame, told: list[str], answer: Answer) -> DataFrame:
    """(block, part, answer), stored, for blocks(block, names, entries, and the columns told).

    names are packed names, the columns told packed numbers in their order, entries says how
    many there are. Put together in order of part, a block's answers are in the order of its names.
    """
    parts = max(1, math.ceil((blocks.agg(F.sum("entries")).first()[0] or 0) / PART_ENTRIES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, names, *numbers = (batch.column(c)[i].as_py() for c in range(2 + len(told)))
                names, numbers = unpacked_names(names), [unpacked(n) for n in numbers]
                cut = [0, *np.searchsorted(names, bounds(parts)).tolist(), len(names)]
                rows = [(k, a, z) for k, (a, z) in enumerate(zip(cut, cut[1:])) if z > a]
                columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([block] * len(rows), pa.int64())]
                columns += [pa.array([packed_names(names[a:z]) for _, a, z in rows], pa.binary())] + [pa.array([packed(n[a:z]) for _, a, z in rows], pa.binary()) for n in numbers]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "names", *told])
        tidy()

    def reply(key: tuple, table: pa.Table) -> pa.Table:
        requests = table["names"].to_pylist()
        distinct, inverse = np.unique(np.concatenate([unpacked_names(r) for r in requests]), return_inverse=True)
        out = answer(inverse, len(distinct), [np.concatenate([unpacked(x) for x in table[t].to_pylist()]) for t in told])
        ends = np.cumsum([packed_count(r) for r in requests])[:-1]
        done = pa.table({"block": table["block"], "part": table["part"], "answer": pa.array([packed(a) for a in np.split(out, ends)], pa.binary())})
        del distinct, inverse, out
        tidy()
        return done

    asked = blocks.select("block", "names", *told).mapInArrow(ask, "part long, block long, names binary, " + ", ".join(f"{t} binary" for t in told))
    return stored(asked.groupBy("part").applyInArrow(reply, "block long, part long, answer binary"), "answers")


def together(answers: pa.Table) -> np.ndarray:
    """A block's answers in the order of its names."""
    rows = sorted(zip(answers["part"].to_pylist(), answers["answer"].to_pylist()))
    return np.concatenate([unpacked(a) for _, a in rows]) if rows else np.empty(0, np.uint64)

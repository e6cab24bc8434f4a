"""Best-fit-decreasing packing of documents into sequences of a fixed number of tokens.

Best fit decreasing looks at lengths alone, and there are at most ``capacity`` of them. So the corpus is counted per
length (partial aggregation; at most ``capacity`` rows come to the driver), best fit decreasing runs over the counts
with a segment tree over remaining capacities, and gives a short plan: the k-th piece of a length goes to which bin. Pieces
are numbered per length without gathering a length in one task, and meet the plan by a join. The result is that of best
fit decreasing over the whole corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import settle

CAPACITY = 1024
END = 2
ROWS_AT_ONCE = 256
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, chunk int, nth long"


class CapacityTree:
    """Which remaining capacities have an open bin; the tightest that holds a length is found in O(log capacity)."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.open = [0] * (2 * self.size)

    def set(self, remaining: int, is_open: bool) -> None:
        at = self.size + remaining
        self.open[at] = int(is_open)
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """Smallest open remaining capacity of at least ``length``."""
        at = self.size + length
        if self.open[at]:
            return length
        while at > 1:  # up to the first right sibling with an open bin, then down its left side
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts of lengths.

    Rows ``(length, first, n, bin, per_bin, offset)``: pieces ``first .. first + n - 1`` of that length fill bins from
    ``bin`` on, ``per_bin`` in each, the first of them at ``offset``. Bins of equal remaining capacity are kept as
    runs, so the plan has a few rows per length, however many documents there are.
    """
    tree, runs, bins, rows = CapacityTree(capacity), defaultdict(list), 0, []

    def add(remaining: int, first: int, n: int) -> None:
        if remaining > 0 and n > 0:
            runs[remaining].append((first, n))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        left, placed = counts[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, n_bins = capacity, -(-left // (capacity // length))
                first, bins = bins, bins + n_bins
            else:
                first, n_bins = runs[remaining].pop()
                if not runs[remaining]:
                    tree.set(remaining, False)
            each = remaining // length
            used = min(n_bins, -(-left // each))
            here = min(left, used * each)
            rows.append((length, placed, here, first, each, capacity - remaining))
            full, rest = divmod(here, each)
            add(remaining - each * length, first, full)
            add(remaining - rest * length, first + full, used - full)
            add(remaining, first + used, n_bins - used)
            left, placed = left - here, placed + here
    return rows


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and its number ``nth`` of its length in ``chunk``.

    A document is its ids and the end id; null text is empty and has the end id alone. Only documents longer than
    ``capacity`` are cut, the first piece taking the remainder.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from wardflow.llm.encode import encoder
        enc, chunk, seen, tail = encoder(vocabulary), TaskContext.get().partitionId(), Counter(), np.uint32(end).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part, rows = batch.slice(at, ROWS_AT_ONCE).to_pydict(), []
                for doc, ids in zip(part["doc_id"], enc.many(part["text"]), strict=True):
                    ids += tail
                    n, start, number = len(ids) // 4, 0, 0
                    while start < n:
                        length = (n - 1) % capacity + 1 if start == 0 else capacity
                        crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                        rows.append((doc, number, start, length, crc, chunk, seen[length]))
                        seen[length] += 1
                        start, number = start + length, number + 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "nth"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every piece and its place.

    Rows that share a doc_id are packed as separate documents; null ids stay null; columns other than doc_id and text
    are not read; an empty table packs to no rows.
    """
    cut = settle(pieces(docs, vocabulary, capacity, end))
    counts = cut.groupBy("chunk", "length").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    before = counts.select("chunk", "length", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    places = docs.sparkSession.createDataFrame(plan(totals, capacity) or [], "length long, first long, n long, bin long, "
                                               "per_bin long, base long")
    rank = (F.col("before") + F.col("nth")).alias("rank")
    numbered = cut.join(before, ["chunk", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", rank).alias("p")
    k = F.col("p.rank") - F.col("q.first")
    # The plan has a few rows per length whatever the corpus holds: bounded by the capacity, so it may be broadcast.
    return (numbered.join(F.broadcast(places.alias("q")), (F.col("p.length") == F.col("q.length"))
                          & F.col("p.rank").between(F.col("q.first"), F.col("q.first") + F.col("q.n") - 1))
            .select("doc_id", "piece", "start", "p.length", "ids_crc32",
                    (F.col("bin") + F.floor(k / F.col("per_bin"))).cast("long").alias("sequence_id"),
                    (F.col("base") + k % F.col("per_bin") * F.col("p.length")).cast("long").alias("offset")))

"""Document fingerprints from prefix polynomial hashes.

``P[i]`` is the sum of ``(code point k + 1) * B**k`` over the first ``i`` code points, modulo two primes. Any two spans of any two texts
are equal if their differences of ``P``, shifted to the same power, are equal; the longest common extension from two places is
found by binary search over span equality. A text's arrays live in the task that reads it. What is kept of it, the
fingerprint, is a bounded excerpt of its array: ``P`` at up to ``LADDER`` multiples of a power of two (prefixes that texts of other
lengths have as well) and at ``ANCHORS`` places chosen by content, the starts of the windows with the smallest hashes of the whole text
(places that survive insertions before them). From two excerpts alone the spans between shared places are compared and the
common beginning is found by binary search, so likeness needs no texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import settle

WINDOW = 16
ANCHORS = 16
LADDER = 8
ROWS_AT_ONCE = 128
_PRIMES = np.array([[2**31 - 1], [2**31 - 19]], dtype=np.uint64)
_BASES = (1_103_515_245, 1_664_525_001)
_ANCHOR = np.dtype([("at", "<u4"), ("window", "<u4"), ("prefix", "<u8")])
_TABLES: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B**k`` and ``B**-k`` for k under ``n``, a row per prime; made by doubling and kept."""
    have = _TABLES.get("up")
    if have is None or have.shape[1] < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        for name, sign in (("up", 1), ("down", -1)):
            rows = []
            for base, (prime,) in zip(_BASES, _PRIMES.tolist(), strict=True):
                row = np.ones(1, np.uint64)
                while len(row) < size:
                    row = np.concatenate([row, row * np.uint64(pow(base, sign * len(row), prime)) % np.uint64(prime)])
                rows.append(row)
            _TABLES[name] = np.stack(rows)
    return _TABLES["up"][:, :n], _TABLES["down"][:, :n]


def _one(pair: np.ndarray) -> np.ndarray:
    """Both residues in one number of 62 bits."""
    return (pair[0] << np.uint64(31)) | pair[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """A text with its prefix arrays."""

    def __init__(self, text: str, like: Hashed | None = None, same: int = 0):
        """The first ``same`` code points are known to be those of ``like``, whose arrays are shared."""
        self.text, self.n = text, len(text)
        codes = np.frombuffer(text[same:].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        up, _ = _powers(self.n + 1)
        head = like.prefix[:, :same + 1] if like else np.zeros((2, 1), np.uint64)
        tail = np.cumsum((codes + np.uint64(1)) * up[:, same:self.n] % _PRIMES, axis=1)
        self.prefix = np.concatenate([head, (head[:, -1:] + tail) % _PRIMES], axis=1)
        known = max(0, same - WINDOW + 1)
        self.windows = _mixed(_one(self._spans(known, WINDOW)))
        if like:
            self.windows = np.concatenate([like.windows[:known], self.windows])

    def _spans(self, first: int, length: int) -> np.ndarray:
        """Values of all spans of a length that start at ``first`` or later."""
        if self.n - length < first:
            return np.empty((2, 0), np.uint64)
        _, down = _powers(self.n + 1)
        ends, starts = self.prefix[:, first + length:], self.prefix[:, first:self.n - length + 1]
        return (ends + _PRIMES - starts) % _PRIMES * down[:, first:self.n - length + 1] % _PRIMES

    def span(self, start: int, end: int) -> int:
        """A number that equal spans of any texts share."""
        _, down = _powers(self.n + 1)
        pair = (self.prefix[:, end] + _PRIMES[:, 0] - self.prefix[:, start]) % _PRIMES[:, 0] * down[:, start] % _PRIMES[:, 0]
        return int(_one(pair))

    def common_extension(self, start: int, other: Hashed, other_start: int) -> int:
        """Code points that agree from the two places on: binary search for the longest equal span."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            half = (low + high + 1) // 2
            if self.span(start, start + half) == other.span(other_start, other_start + half):
                low = half
            else:
                high = half - 1
        return low

    def excerpt(self) -> Excerpt:
        step = 1 << max(0, -(-self.n // LADDER) - 1).bit_length()
        take = ANCHORS
        while True:  # windows may repeat, so more than ANCHORS of the smallest are looked at until so many differ
            take = min(4 * take, len(self.windows))
            places = np.sort(np.argpartition(self.windows, take - 1)[:take]) if take < len(self.windows) else np.arange(take)
            values, first = np.unique(self.windows[places], return_index=True)
            if take == len(self.windows) or len(values) > ANCHORS:
                break
        # the largest of those looked at may have an earlier place that was cut off; it is not among the smallest ANCHORS
        at = np.sort(places[first[:ANCHORS]])
        anchors = np.empty(len(at), _ANCHOR)
        anchors["at"], anchors["window"], anchors["prefix"] = at, self.windows[at] >> np.uint64(32), _one(self.prefix[:, at])
        return Excerpt(self.n, int(_one(self.prefix[:, -1])), _one(self.prefix[:, step::step]), anchors)


class Excerpt:
    """What a fingerprint holds: length, ``P`` of the whole, of the ladder's prefixes, and at the anchors."""

    def __init__(self, n: int, whole: int, ladder: np.ndarray, anchors: np.ndarray):
        self.n, self.whole, self.ladder, self.anchors = n, whole, ladder, anchors
        self.step = 1 << max(0, -(-n // LADDER) - 1).bit_length()

    def packed(self) -> bytes:
        return np.array([self.n, self.whole], "<u8").tobytes() + self.ladder.astype("<u8").tobytes() + self.anchors.tobytes()

    def __str__(self) -> str:
        return base64.b64encode(self.packed()).decode("ascii")

    @classmethod
    def read(cls, fingerprint: str) -> Excerpt:
        raw = base64.b64decode(fingerprint)
        n, whole = np.frombuffer(raw, "<u8", 2).tolist()
        out = cls(n, whole, np.empty(0, np.uint64), np.empty(0, _ANCHOR))
        rungs = n // out.step
        out.ladder = np.frombuffer(raw, "<u8", rungs, 16)
        out.anchors = np.frombuffer(raw, _ANCHOR, offset=16 + 8 * rungs)
        return out

    def places(self) -> dict[int, tuple[int, int]]:
        return {w: (at, p) for at, w, p in self.anchors.tolist()}


def _span(start: tuple[int, int], end: tuple[int, int]) -> tuple[int, ...]:
    """Value of the span between two places with known ``P``."""
    out = []
    for k, base in enumerate(_BASES):
        prime = int(_PRIMES[k, 0])
        low, high = (x[1] >> 31 if k == 0 else x[1] & (2**31 - 1) for x in (start, end))
        out.append((high - low) * pow(base, -start[0], prime) % prime)
    return tuple(out)


def _covered(intervals: list[tuple[int, int]]) -> int:
    total = reach = 0
    for start, end in sorted(intervals):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def likeness(a: Excerpt, b: Excerpt) -> float:
    """Share of both texts' code points that lie in spans which the excerpts show to be equal; 1 for equal texts, also empty ones."""
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    if not a.n or not b.n:
        return 0.0
    step = max(a.step, b.step)
    low, high = 0, min(a.n, b.n) // step
    while low < high:  # longest common prefix on the rungs that both have
        half = (low + high + 1) // 2
        if a.ladder[half * step // a.step - 1] == b.ladder[half * step // b.step - 1]:
            low = half
        else:
            high = half - 1
    in_a, in_b = [(0, low * step)], [(0, low * step)]
    theirs = b.places()
    met = [((at, p), theirs[w]) for w, (at, p) in a.places().items() if w in theirs]
    chain = [((0, 0), (0, 0)), *sorted(met), ((a.n, a.whole), (b.n, b.whole))]
    for k in range(1, len(chain)):
        (a0, b0), (a1, b1) = chain[k - 1], chain[k]
        if k < len(chain) - 1:
            in_a.append((a1[0], a1[0] + WINDOW))
            in_b.append((b1[0], b1[0] + WINDOW))
        if a1[0] - a0[0] == b1[0] - b0[0] > 0 and _span(a0, a1) == _span(b0, b1):
            in_a.append((a0[0], a1[0]))
            in_b.append((b0[0], b1[0]))
    return min(1.0, (_covered(in_a) + _covered(in_b)) / (a.n + b.n))


def edited_text(own: str, following: str) -> tuple[str, int]:
    """The last quarter of a text replaced by as much of the beginning of the next one; and how much of the text is left."""
    gone = len(own) // 4
    return own[:len(own) - gone] + following[:gone], len(own) - gone


def _finished(own: Hashed, excerpt: Excerpt, following: str, next_excerpt: Excerpt) -> tuple:
    text, same = edited_text(own.text, following)
    changed = Hashed(text, own, same).excerpt()
    return (own.n, hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), excerpt.packed(), changed.packed(),
            likeness(excerpt, changed), likeness(excerpt, next_excerpt))


_RESULT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_EDGE = "part int, first boolean, text string"
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.string()]
_NAMES = [c.split(" ")[0] for c in f"{_RESULT}, {_EDGE}".split(", ")]


def _batch(rows: list[tuple], width: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES[:width], strict=True)], _NAMES[:width])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows whose next row is in the same range, then the range's edges: its first text, and its last row."""
    part, before, out = TaskContext.get().partitionId(), None, []
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            for doc, text in zip(*[c.to_pylist() for c in batch.slice(at, ROWS_AT_ONCE).columns[:2]], strict=True):
                own = Hashed(text or "")
                excerpt = own.excerpt()
                if before is None:
                    out.append((None,) * 7 + (part, True, own.text))
                else:
                    out.append((before[0], *_finished(before[1], before[2], own.text, excerpt), None, None, None))
                before = doc, own, excerpt
            yield _batch(out, 10)
            out = []
    if before is not None:
        yield _batch([(before[0], *(None,) * 6, part, False, before[1].text)], 10)


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            doc, text, following = [c[0].as_py() for c in batch.slice(at, 1).columns]
            own = Hashed(text)
            yield _batch([(doc, *_finished(own, own.excerpt(), following, Hashed(following).excerpt()))], 7)


def _one_line(column: str) -> Column:
    return F.translate(F.base64(column), "\r\n", "").alias(column)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The next document is the next in ascending id; a null id comes first, rows that share an id follow one another by a hash of
    their texts, and after the last comes the first. Null texts are empty; empty texts have equal fingerprints and a likeness of 1
    to each other, 0 to any other. Texts of any length are read whole, one at a time. Other columns are not read. An empty
    table gives no rows. Equal texts have equal fingerprints wherever they stand.

    Rows are dealt by ranges of (id, hash of the text, row), so that a repeated id spreads, and each range is read in order, one row
    ahead; the last row of a range meets the first text of the next one by a join of two rows a range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keys = [F.col("doc_id"), F.col("_hash"), F.col("_row")]
    ranged = (rows.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
              .repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text"))
    found = settle(ranged.mapInArrow(_in_order, f"{_RESULT}, {_EDGE}"))
    firsts = found.filter("first").select("part", F.col("text").alias("following"))
    lasts = found.filter("not first").select("part", "doc_id", "text")
    # numbers of ranges alone: as many rows as the shuffle had partitions
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(everything)).alias("next"))
    edges = (lasts.join(order, "part").join(firsts.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following")
             .mapInArrow(_at_edges, _RESULT))
    return found.filter("part is null").drop("part", "first", "text").unionByName(edges).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), _one_line("fingerprint"), _one_line("edited_fingerprint"), "near_edited", "near_next")

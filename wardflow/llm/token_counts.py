"""Exact token counts at every prefix of a text, by prefix dynamic programming.

For byte-pair encoding the last token of a prefix decides its count: ``count[i] = count[i - len(t)] + 1``, where ``t`` is the one
token ending at byte ``i`` that is compatible with the last token before it (the pair encodes to itself). One pass gives
the count of every prefix of a piece, so truncation and budget questions need no second encoding. Pieces are joined as
the tokenizer splits texts, with corrections where a prefix is split differently from the whole: runs of white space,
contractions, special strings. The table of a text has one signed byte per code point: by how much the count changes.
Tables of units (see ``encode.keys``) are remembered per worker, since most words repeat. Counts of whole units are remembered
apart: where no table is asked for, a text's count is the sum of its units' counts, and a budget needs the table of the one unit
in which it runs out.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.encode import Remembered, keys, unit_of

ROWS_AT_ONCE = 128
# The pre-tokenizer's pattern.
PIECE = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
RUN = regex.compile(r"\s{2,}(?=\S)")
TWO_WHITE = re.compile(r"\s\s")
MOST_STATES = 1_200_000
MOST_WORDS = 150_000
MOST_PAIRS = 500_000
LONG_PIECE = 64
NEVER = 1 << 30
NO_TOKEN = (1 << 20) - 1
NOTHING = NO_TOKEN << 16
ONE = (1,)
LATIN_END = "\u0250"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


def _byte_of_symbol() -> dict[str, int]:
    """The vocabulary file writes each byte as one printable character: itself, or the next unused code from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PrefixCounter:
    """Prefix token counts under a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str, most: int = 300_000):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        symbols = _byte_of_symbol()
        raw = lambda s: bytes(symbols[c] for c in s)
        self.specials = [t["content"] for t in model["added_tokens"]]
        self.tokens = {raw(t): k for k, t in enumerate(t for t in model["model"]["vocab"] if t not in self.specials)}
        self.spelt = list(self.tokens)
        self.rank = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[raw(a), raw(b)] = rank
        self.lengths = self._lengths()
        self.made: dict[bytes, tuple[bytes, bytes, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.states: dict[bytes, int] = {b"": NOTHING}
        self.memory = Remembered(lambda parts: [self._table(u) for u in parts], most)
        self.totals = Remembered(lambda parts: [self._total(u) for u in parts], 2 * most)

    def _lengths(self) -> dict[bytes, list[int]]:
        """For every end of one to three bytes that tokens have: the lengths of tokens that can end there, longest first."""
        sizes: dict[bytes, set[int]] = {}
        for t in self.tokens:
            sizes.setdefault(t[-3:], set()).add(len(t))
        for end in sorted(sizes, key=len):
            for k in range(1, len(end)):
                sizes[end] |= {n for n in sizes.get(end[k:], ()) if n <= len(end) - k}
        short: dict[bytes, set[int]] = {}
        for end in sizes:
            for k in range(1, len(end)):
                short.setdefault(end[k:], set()).update(n for n in range(1, len(end) - k + 1) if end[len(end) - n:] in self.tokens)
        return {end: sorted(found, reverse=True) for end, found in {**short, **sizes}.items()}

    def merge(self, piece: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """Plain BPE of a short piece, lowest-ranked neighbours first; and the last two parts that were merged."""
        parts, last = [piece[i:i + 1] for i in range(len(piece))], None
        while len(parts) > 1:
            ranked = [(self.rank.get(p, NEVER), i) for i, p in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == NEVER:
                break
            last = parts[i], parts[i + 1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts, last

    def _made(self, token: bytes) -> tuple[bytes, bytes, int] | None:
        """The two parts a token is merged of at last and the rank of that merge; None if its bytes encode to something else."""
        made = self.made.get(token, 0)
        if made == 0:
            parts, last = self.merge(token)
            made = self.made[token] = None if len(parts) > 1 else (b"", b"", -1) if last is None else (*last, self.rank[last])
        return made

    def _fits(self, left: bytes, right: bytes) -> bool:
        """Whether the pair encodes to itself: at no time would a merge across their border have come before those inside.

        Walks back in time along the parts that touch the border; each pair of them could be merged until either became part of more.
        """
        made, ranks = self.made, self.rank
        at_left, at_right = self._made(left), self._made(right)
        if at_right is None:
            return False
        until_left = until_right = NEVER
        while True:
            rank = ranks.get((left, right))
            if rank is not None and rank < until_left and rank <= until_right:  # of equal ranks the one further left comes first
                return False
            if at_left[2] > at_right[2]:
                until_left, left = at_left[2], at_left[1]
                at_left = made.get(left) or self._made(left)
            elif at_right[2] >= 0:
                until_right, right = at_right[2], at_right[0]
                at_right = made.get(right) or self._made(right)
            else:
                return True

    def _follows(self, left: int, right: int) -> bool:
        """``_fits`` of two tokens by number, remembered; ``left`` may be ``NO_TOKEN``, the start of a piece."""
        key = left << 20 | right
        fits = self.pairs.get(key)
        if fits is None:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            token = self.spelt[right]
            fits = self.pairs[key] = self._made(token) is not None if left == NO_TOKEN else self._fits(self.spelt[left], token)
        return fits

    def state(self, raw: bytes) -> int:
        """``last token << 16 | count`` of a short piece.

        ``states`` remembers those of all its prefixes, and words of a language share their beginnings, so mostly the
        last few bytes of a new word are worked out.
        """
        states, tokens, lengths, pairs = self.states, self.tokens, self.lengths, self.pairs
        if (found := states.get(raw)) is not None:
            return found
        if len(states) > MOST_STATES:
            states = self.states = {b"": NOTHING}
        n = len(raw)
        known = n - 1
        while raw[:known] not in states:
            known -= 1
        for i in range(known + 1, n + 1):
            end = raw[i - 3:i] if i > 2 else raw[:i]
            for size in lengths.get(end) or lengths.get(end[1:], ONE):
                if size <= i and (token := tokens.get(raw[i - size:i])) is not None:
                    before = states[raw[:i - size]]
                    fits = pairs.get(before >> 16 << 20 | token)
                    if fits is None:
                        fits = self._follows(before >> 16, token)
                    if fits:
                        found = states[raw[:i]] = token << 16 | (before & 0xFFFF) + 1
                        break
        return found

    def piece_counts(self, piece: str) -> list[int]:
        """Count of every code point prefix of one piece of the pre-tokenizer."""
        raw = piece.encode("utf-8")
        self.state(raw)
        states, n = self.states, len(raw)
        at = range(1, n + 1) if n == len(piece) else [i for i in range(1, n + 1) if i == n or raw[i] & 0xC0 != 0x80]
        out = [states[raw[:i]] & 0xFFFF for i in at]
        if piece in LONG_CONTRACTIONS:  # its two-character prefix is not a contraction: a quote, then a letter
            out[1] = 2
        return out

    def long_counts(self, piece: str) -> list[int]:
        """``piece_counts`` of a piece too long to remember its prefixes."""
        raw, tokens, n = piece.encode("utf-8"), self.tokens, len(piece.encode("utf-8"))
        last, count = [NO_TOKEN] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            end = raw[max(i - 3, 0):i]
            for size in self.lengths.get(end) or self.lengths.get(end[1:], ONE):
                token = tokens.get(raw[i - size:i]) if size <= i else None
                if token is not None and self._follows(last[i - size], token):
                    last[i], count[i] = token, count[i - size] + 1
                    break
        return [count[i] for i in range(1, n + 1) if i == n or raw[i] & 0xC0 != 0x80]

    def _counts(self, piece: str) -> list[int]:
        found = self.words.get(piece)
        if found is None:
            if len(piece) > LONG_PIECE:
                return self.long_counts(piece)
            if len(self.words) > MOST_WORDS:
                self.words.clear()
            found = self.words[piece] = self.piece_counts(piece)
        return found

    def _ordinary(self, text: str) -> list[int]:
        """Changes of the count, code point by code point, of a text without special strings."""
        out: list[int] = []
        for piece in PIECE.findall(text):
            counts = self._counts(piece)
            out.append(counts[0])
            out += map(sub, counts[1:], counts)
        if TWO_WHITE.search(text):
            for run in RUN.finditer(text):  # at its end a prefix still has the run in one piece
                white, end = run.group(), run.end()
                more = self._counts(white)[-1] - self._counts(white[:-1])[-1] - self._counts(white[-1])[-1]
                out[end - 1] += more
                out[end] -= more
        return out

    def _table(self, unit: str) -> bytes:
        out: list[int] = []
        while "<|" in unit and (hit := min(((unit.find(s), s) for s in self.specials if s in unit), default=None)):
            at, special = hit
            partial = self._ordinary(unit[:at] + special[:-1])
            out += partial
            out.append(sum(self._ordinary(unit[:at])) + 1 - sum(partial))
            unit = unit[at + len(special):]
        out += self._ordinary(unit)
        return array("b", out).tobytes()

    def _total(self, unit: str) -> int:
        """Tokens of a whole unit: where it has no special string or run of white space, those of its pieces."""
        if len(unit) <= LONG_PIECE and unit[0] == " " and unit[1:].isalpha() and max(unit) < LATIN_END:
            return self.state(unit.encode("utf-8")) & 0xFFFF
        if "<|" in unit or len(unit) > LONG_PIECE or TWO_WHITE.search(unit):
            return int(np.frombuffer(self._table(unit), np.int8).sum(dtype=np.int64))
        return sum([self.state(piece.encode("utf-8")) & 0xFFFF for piece in PIECE.findall(unit)])

    def counted(self, text: str | None, budget: int) -> tuple[int, int]:
        """Tokens of a text, and the code points of its longest prefix of at most ``budget`` tokens.

        A unit's first character adds a token at least, so the budget runs out in the last unit that begins below it or, if not
        even its first character fits, before it.
        """
        parts = keys(text or "")
        totals = self.totals.of(parts)
        n = sum(totals)
        if n <= budget:
            return n, len(text or "")
        starts = list(accumulate(totals, initial=0))
        at = next(k for k in range(len(parts) - 1, -1, -1) if starts[k] < budget or k == 0)
        within = longest_prefix(self.memory.of([parts[at]])[0], budget - starts[at])
        return n, sum(len(unit_of(k)) for k in parts[:at]) + within

    def table(self, text: str | None) -> bytes:
        """The prefix table of a text."""
        return b"".join(self.memory.of(keys(text or "")))


def count_at(table: bytes, n_chars: int) -> int:
    """Tokens of the prefix of ``n_chars`` code points."""
    return int(np.frombuffer(table, np.int8)[:n_chars].sum(dtype=np.int64))


def longest_prefix(table: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    counts = np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64)
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    within = np.flatnonzero(counts <= budget)
    return int(within[-1]) + 1 if len(within) else 0


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_prefixes(docs: DataFrame, vocabulary: str, budget: int = 1024, id_col: str = "doc_id",
                   text_col: str = "text", tables: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, fit_chars, prefix_table`` of every row.

    ``fit_chars`` are the code points of the longest prefix within ``budget`` tokens. ``prefix_table`` (null unless
    ``tables``) answers any other question through ``count_at`` and ``longest_prefix``. Null and empty texts have 0 of everything;
    repeated rows are counted each; a null id stays null; other columns are not read. Texts of any length are
    counted whole, a row at a time.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = part.column(1).to_pylist()
                made = [counter.table(t) for t in texts] if tables else [None] * len(texts)
                counted = [(count_at(t, len(t)), longest_prefix(t, budget)) for t in made] if tables else [counter.counted(t, budget) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64()),
                     pa.array([n for n, _ in counted], pa.int64()), pa.array([fit for _, fit in counted], pa.int64()),
                     pa.array(made, pa.binary())],
                    ["doc_id", "n_bytes", "n_tokens", "fit_chars", "prefix_table"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, fit_chars long, prefix_table binary")

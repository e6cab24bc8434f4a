"""Personal data by a semi-Markov conditional random field over candidate spans.

A text is cut around what personal data has (digits, ``@``, ``+``, ``(at)`` in any case): everything else is outside. In each zone, atoms
(runs of letters, runs of digits, single other characters) are the positions; a segment is one outside atom, or up to ``MOST_ATOMS``
atoms taken together as an email, an ip address, a card or a phone number. Features look at the whole segment and what stands
around it, so boundaries and types are chosen jointly, by dynamic programming over segments of bounded length: the best
segmentation when finding, sums over all segmentations when training. Weights are trained here, on zones of a bounded
sample whose labels are the base patterns' matches plus rewritten forms of them (separators changed, ``(at)`` and ``(dot)``).

The base matches always stay; segments that the field finds apart from them are added.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
MOST_ATOMS = 24
ROWS_AT_ONCE = 128
TRAIN_ROWS = 3_000

# The base patterns of the contract.
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_HEAD = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each ``@`` backwards: the part before it starts where its characters do."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_CHARS:
            start -= 1
        tail = _EMAIL_TAIL.match(text, at) if start < at else None
        if tail:
            done = tail.end()
            yield start, done, "email"
        at = text.find("@", max(at + 1, done))


def _ascii_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The contract's matches, by start and then kind as listed."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = _ascii_digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_ascii_digits(m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# ---- the field ----

_SIGNAL = re.compile(r"[0-9@+]|\(at\)", re.I)
_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
_REACH = 40
_NUMERIC = frozenset("0123456789+-.()/ \t\n")


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches that hold a digit, ``@``, ``+`` or ``(at)`` and what stands within a few dozen characters, cut at white space or symbols."""
    out: list[list[int]] = []
    for m in _SIGNAL.finditer(text):
        start, end = max(0, m.start() - _REACH), min(len(text), m.end() + _REACH)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def atoms(zone: str) -> list[tuple[int, int]]:
    return [m.span() for m in _ATOM.finditer(zone)]


def features(zone: str, start: int, end: int) -> list[str] | None:
    """Names of what holds for a whole segment; None where it cannot be an entity (no signal, or space at an edge)."""
    text = zone[start:end]
    if text[0].isspace() or text[-1].isspace() or not _SIGNAL.search(text):
        return None
    digits = _ascii_digits(text)
    n, ats, dots = len(digits), text.count("@") + text.lower().count("(at)"), text.count(".") + text.lower().count("(dot)")
    letters = sum(c.isalpha() for c in text)
    before, after = zone[start - 1:start], zone[end:end + 1]
    groups = [g for g in re.split(r"[^0-9]+", text) if g]
    cues = [f"digits:{n if n < 20 else 20}", f"ats:{min(ats, 2)}", f"dots:{min(dots, 4)}", f"letters:{min(letters, 1) if not ats else 2}",
            f"groups:{min(len(groups), 6)}", f"first:{_shape(text[0])}", f"last:{_shape(text[-1])}", f"before:{_shape(before)}", f"after:{_shape(after)}",
            f"plus:{text[0] == '+'}", f"spaces:{min(sum(c.isspace() for c in text), 4)}"]
    if n and not letters:
        cues.append(f"luhn:{14 <= n <= 19 and luhn(digits)}")
        cues.append(f"octets:{len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
        cues.append(f"phone:{text[0] == '+' and 10 <= n <= 15}")
    if ats:
        tail = re.split(r"@|\(at\)", text, maxsplit=1, flags=re.I)[1]
        cues += [f"domain:{bool(re.fullmatch(r'[A-Za-z0-9-]+((\.|\(dot\))[A-Za-z0-9-]+)+', tail, re.I | re.A))}", f"head:{text[0].isalnum()}"]
    if set(text) - set("0123456789+-.() @_%") and not ats:
        cues.append("other")
    return cues


def _shape(c: str) -> str:
    return "none" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c


class SemiCRF:
    """Weights per (kind, feature); a segmentation scores the sum over its entity segments, outside atoms score 0."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}

    def segments(self, zone: str, cut: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
        """Candidate segments ``(first atom, atom after the last, features)``, by their end.

        An entity is digits with separators, or holds an at-sign and no space; longer segments are not tried once neither can be.
        """
        out = []
        for i, (start, _) in enumerate(cut):
            if zone[start].isspace():
                continue
            other = space = False
            for j in range(i + 1, min(len(cut), i + MOST_ATOMS) + 1):
                a, end = cut[j - 1]
                space = space or zone[a].isspace()
                other = other or not _NUMERIC.issuperset(zone[a:end])
                if space and other or end - start > 80:
                    break
                text = zone[start:end]
                if (not other or "@" in text or "(at)" in text.lower()) and (cues := features(zone, start, end)) is not None:
                    out.append((i, j, cues))
        return sorted(out, key=lambda s: s[1])

    def scores(self, cues: list[str]) -> list[float]:
        w = self.weights
        return [w.get(f"{kind}|bias", -4.0) + sum(w.get(f"{kind}|{c}", 0.0) for c in cues) for kind in KINDS]

    def best(self, zone: str) -> list[Span]:
        cut = atoms(zone)
        n, ending = len(cut), {}
        for i, j, cues in self.segments(zone, cut):
            ending.setdefault(j, []).append((i, self.scores(cues)))
        top, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            top[j] = top[j - 1]
            for i, values in ending.get(j, ()):
                for kind, value in zip(KINDS, values, strict=True):
                    if top[i] + value > top[j]:
                        top[j], back[j] = top[i] + value, (i, kind)
        found, j = [], n
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                found.append((cut[i][0], cut[j - 1][1], kind))
                j = i
        return found[::-1]

    def gradient(self, zone: str, truth: Sequence[Span]) -> tuple[float, dict[str, float]]:
        """Log likelihood of the true segmentation and its gradient: what it holds less what all segmentations hold on average."""
        cut = atoms(zone)
        n, scored = len(cut), [(i, j, cues, self.scores(cues)) for i, j, cues in self.segments(zone, cut)]
        ending, starting = {}, {}
        for i, j, _, values in scored:
            total = float(np.logaddexp.reduce(values))
            ending.setdefault(j, []).append((i, total))
            starting.setdefault(i, []).append((j, total))
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = float(np.logaddexp.reduce([ahead[j - 1], *[ahead[i] + v for i, v in ending.get(j, ())]]))
        for i in range(n - 1, -1, -1):
            behind[i] = float(np.logaddexp.reduce([behind[i + 1], *[behind[j] + v for j, v in starting.get(i, ())]]))
        wanted = {(a, b): kind for a, b, kind in truth}
        grad: dict[str, float] = {}
        likelihood = -ahead[n]
        for i, j, cues, values in scored:
            kind_here = wanted.get((cut[i][0], cut[j - 1][1]))
            for kind, v in zip(KINDS, values, strict=True):
                step = float(kind == kind_here) - float(np.exp(ahead[i] + v + behind[j] - ahead[n]))
                likelihood += v if kind == kind_here else 0.0
                if abs(step) > 1e-4:
                    for c in ("bias", *cues):
                        grad[f"{kind}|{c}"] = grad.get(f"{kind}|{c}", 0.0) + step
        return likelihood, grad


def _apart(spans: list[Span]) -> list[Span]:
    """Base matches without overlaps, the longer first: one segmentation to learn from."""
    kept: list[Span] = []
    for s in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
        if all(s[1] <= k[0] or s[0] >= k[1] for k in kept):
            kept.append(s)
    return sorted(kept)


def _rewritten(zone: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """The zone with its entities in other forms that the base patterns do not know."""
    out, marks, at = [], [], 0
    for start, end, kind in spans:
        out.append(zone[at:start])
        text = zone[start:end]
        if kind == "email":
            head, _, domain = text.rpartition("@")
            text = f"{head}(at){domain.replace('.', '(dot)') if rng.random() < 0.5 else domain}"
        elif kind == "card":
            text = re.sub(r"[ -]", ".", text) if re.search(r"[ -]", text) else text
        where = sum(map(len, out))
        marks.append((where, where + len(text), kind))
        out.append(text)
        at = end
    return "".join([*out, zone[at:]]), marks


def fit(texts: Sequence[str], seed: int = 5, rounds: int = 3, most_zones: int = 300) -> SemiCRF:
    """Train on zones of the texts, in the order given, by stochastic gradient ascent with a small L2 penalty.

    At most ``most_zones`` zones with entities and as many without are used.
    """
    rng, examples, plain = np.random.default_rng(seed), [], []
    for text in texts:
        spans = _apart(base_spans(text))
        for a, b in zones(text):
            if b - a > 400 or any(s < a < e or s < b < e for s, e, _ in spans):
                continue
            zone, inside = text[a:b], [(s - a, e - a, k) for s, e, k in spans if a <= s and e <= b]
            if inside and len(examples) < 2 * most_zones:
                examples += [(zone, inside), _rewritten(zone, inside, rng)]
            elif not inside and len(plain) < most_zones:
                plain.append((zone, []))
    field = SemiCRF({f"{k}|bias": -4.0 for k in KINDS})
    lessons = [x for x in examples + plain if set(a for a, _, _ in x[1]) <= {s for s, _ in atoms(x[0])}]
    for turn in range(rounds):
        rate = 0.2 / (1 + turn)
        for k in rng.permutation(len(lessons)):
            _, grad = field.gradient(*lessons[k])
            for name, step in grad.items():
                w = field.weights.get(name, 0.0)
                field.weights[name] = w + rate * (step - 0.001 * w)
    return field


def train(docs: DataFrame, max_rows: int = TRAIN_ROWS) -> SemiCRF:
    """Fit on at most ``max_rows`` short texts with a digit, ``@``, ``+`` or ``(at)``: those with the smallest hash of their id and text.

    Such texts are counted first, and only one in so many by hash is ordered, so that what tasks send to the driver is bounded by
    ``max_rows`` and not by the number of tasks.
    """
    fit_for = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("hash")).filter(
        F.col("text").rlike(r"(?i)[0-9@+]|\(at\)") & (F.char_length("text") < 4000))
    one_in = max(1, fit_for.count() // (2 * max_rows))
    sample = fit_for.filter(F.pmod("hash", F.lit(one_in)) == 0).orderBy("hash", "doc_id").limit(max_rows)
    return fit([r["text"] for r in sample.collect()])


def find(text: str, field: SemiCRF, base: list[Span] | None = None) -> list[Span]:
    """Base matches, and the field's segments that overlap none of them; by start, then kind as listed."""
    base = base_spans(text) if base is None else base
    starts, reach, added = [x[0] for x in base], list(accumulate((x[1] for x in base), max)), []
    for a, b in zones(text):
        for s, e, kind in field.best(text[a:b]):
            s, e = s + a, e + a
            before = bisect_left(starts, e)  # base spans that start before the segment ends
            if not before or reach[before - 1] <= s:
                added.append((s, e, kind))
    return sorted([*base, *added], key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def personal_data(docs: DataFrame, field: SemiCRF) -> DataFrame:
    """``doc_id, base, spans`` of every row: the base matches and all spans, as ``array<struct<start, end, kind>>``.

    Offsets are code points, ends exclusive. Null and empty texts have none; texts of any length are searched whole; repeated rows
    are searched each; a null id stays null; other columns are not read; an empty table gives no rows.
    """
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part, base, all_ = batch.slice(at, ROWS_AT_ONCE), [], []
                for text in part.column(1).to_pylist():
                    known = base_spans(text) if text and _SIGNAL.search(text) else []
                    base.append([dict(zip(("start", "end", "kind"), s)) for s in known])
                    every = find(text, field, known) if text and _SIGNAL.search(text) else []
                    all_.append([dict(zip(("start", "end", "kind"), s)) for s in every])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(base, pa.list_(kind)), pa.array(all_, pa.list_(kind))], ["doc_id", "base", "spans"])

    spans = "array<struct<start: long, end: long, kind: string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        search, f"doc_id long, base {spans}, spans {spans}")


def redacted(docs: DataFrame, field: SemiCRF) -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in square brackets; of overlapping spans the first stays."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                parts, at = [], 0
                for s, e, kind in find(text or "", field):
                    if s >= at:
                        parts += [(text or "")[at:s], f"[{kind}]"]
                    at = max(at, e)
                out.append(None if text is None else "".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "doc_id long, text string")


def as_text(spans: str):
    """Column text ``kind:start:end`` of a span array, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Repair of conversation structure at least cost, with an audit of the edits.

A conversation must read ``(system? (user assistant)+)?``. Its rows are kept, rerolled or deleted and empty turns inserted, by dynamic
programming over four states of that pattern. Every state's audit is a node of a persistent tree: prefixes are shared, a node
knows its ancestors at powers of two and a rolling hash of its string. Equally cheap audits are compared by a search for their
longest common prefix over those ancestors; a prefix that hashes call equal is walked and verified.

Rows are dealt by ranges of (conversation, turn), so one conversation may lie in many tasks. Conversations that lie inside a
range and are short are finished as the range is read. Those at an edge of a range, and long ones, go by blocks of ``BLOCK`` rows:
each block gives the best audit from every state to every state, blocks are folded in order (one row a block), and
each block writes its own part of the repaired text, which is hashed in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import WHITE, crc32_sql
from wardflow.session import settle

BLOCK = 128
WHOLE_ROWS = 2048
WHOLE_CHARS = 8_000_000
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
_MOD = (1 << 61) - 1
_BASE = 1_000_003
Best = tuple[int, int] | None  # cost, node


class Audits:
    """Strings of edits as nodes of a tree; node 0 is the empty string."""

    def __init__(self):
        self.char, self.depth, self.hash, self.up = [""], [0], [0], [[0]]

    def add(self, parent: int, char: str) -> int:
        node = len(self.char)
        self.char.append(char)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(char)) % _MOD)
        ups, k = [parent], 0
        while k < len(self.up[ups[k]]) and ups[k]:
            ups.append(self.up[ups[k]][k])
            k += 1
        self.up.append(ups)
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            ups, more = self.up[node], self.depth[node] - depth
            node = ups[min(more.bit_length(), len(ups)) - 1]
        return node

    def _same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth spell the same, walked up to where they are one node."""
        while x != y:
            if self.char[x] != self.char[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether x spells the smaller string."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self._lifted(x, depth), self._lifted(y, depth)
        if self.hash[a] == self.hash[b]:
            return self.depth[x] < self.depth[y] if self._same(a, b) else self.text(x) < self.text(y)
        for k in reversed(range(depth.bit_length())):
            if k < len(self.up[a]) and k < len(self.up[b]):
                p, q = self.up[a][k], self.up[b][k]
                if self.hash[p] != self.hash[q]:
                    a, b = p, q
        p, q = self.up[a][0], self.up[b][0]
        return self.char[a] < self.char[b] if self._same(p, q) else self.text(x) < self.text(y)

    def better(self, now: Best, cost: int, parent: int, char: str) -> Best:
        """The cheaper of what there is and one more edit; of equal cost the smaller string."""
        if now is not None and cost > now[0]:
            return now
        node = self.add(parent, char)
        return (cost, node) if now is None or cost < now[0] or self.less(node, now[1]) else now

    def inserted(self, best: list[Best]) -> list[Best]:
        """With empty turns put in wherever that is the best way to a state."""
        best = list(best)
        for source, target in ((NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if best[source]:
                best[target] = self.better(best[target], best[source][0] + INSERT, best[source][1], "I")
        return best

    def after(self, best: list[Best], initial: str, fault: str | None) -> list[Best]:
        """One row on."""
        best, out = self.inserted(best), [None] * 4
        more = UNFINISHED if fault == "truncated" else 0
        for state, have in enumerate(best):
            if have is None:
                continue
            cost, node = have
            out[state] = self.better(out[state], cost + DELETE, node, "D")
            if fault in ("blank", "duplicate"):
                continue
            target = ASSISTANT if state == USER else USER
            kept = {"s": SYSTEM if state == NOTHING else None, "u": target if target == USER else None,
                    "a": target if target == ASSISTANT else None}.get(initial)
            if kept is not None:
                out[kept] = self.better(out[kept], cost + more, node, "K")
            out[target] = self.better(out[target], cost + REROLE + more, node, "R")
        return out


def fault_of(text: str, seen: bool) -> str | None:
    last = text.rstrip(WHITE)[-1:]
    return "blank" if not last else "duplicate" if seen else None if last in ".!?" else "truncated"


def cheapest(rows: list[tuple[str, str | None]]) -> tuple[int, str]:
    """Cost and audit of ``(role initial, fault)`` rows."""
    tree, best = Audits(), [(0, 0), None, None, None]
    for initial, fault in rows:
        best = tree.after(best, initial, fault)
    best = tree.inserted(best)
    ends = [x for x in (best[NOTHING], best[ASSISTANT]) if x]
    cost = min(c for c, _ in ends)
    found = [n for c, n in ends if c == cost]
    return cost, tree.text(found[0] if len(found) == 1 or tree.less(found[0], found[1]) else found[1])


def repaired(rows: Iterator[tuple[str, str]], audit: str, before: int, has_system: bool) -> str | None:
    """Lines ``role:text`` of rows under their part of an audit; ``before`` lines come earlier. Null if there are none."""
    lines, rows = [], iter(rows)
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if (before + len(lines) - has_system) % 2 else "user"
        lines.append(f"{role}:{text}")
    return "\n".join(lines) if lines else None


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROWS = "at long, turn long, role string, text string, gone boolean, fault string, key binary"
_KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _fields(columns: str, conv: pa.DataType) -> list[tuple[str, pa.DataType]]:
    return [("conv_id", conv), *[(c.split(" ")[0], _KINDS[c.split(" ")[1]]) for c in columns.split(", ")]]


def _batch(rows: list[tuple], columns: str, conv: pa.DataType) -> pa.RecordBatch:
    fields = _fields(columns, conv)
    columns_of = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns_of, fields, strict=True)], [n for n, _ in fields])


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone, tie, row, copy``: rows as the drill damages them; ``gone`` rows are dropped ones.

    ``tie`` orders rows of one turn: SHA-256 of their role and text.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"),
                                kind.alias("kind"), F.monotonically_increasing_id().alias("row"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("kind") == 0).alias("gone"), F.sha2(F.concat("role", F.lit(":"), "text"), 256).alias("tie"), "row",
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _read_range(batches: Iterator[pa.RecordBatch], conv: pa.DataType, whole_rows: int) -> Iterator[pa.RecordBatch]:
    """Finished conversations of a range, and the rows of those that may go on in another range or are long."""
    columns = f"{_COUNTS}, {_ROWS}"
    first_at, out, held, chars, run, run_is_first, open_ = TaskContext.get().partitionId() << 40, [], [], 0, None, True, True
    seq = 0

    def opened(rows: list[tuple]) -> None:
        nonlocal seq
        for turn, role, text, gone in rows:
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
            out.append((run[0], *(None,) * 8, first_at + seq, turn, role, text, gone, fault_of(text, False), key))
            seq += 1

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for conv_id, turn, role, text, gone in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True):
                if run is None or run[0] != conv_id:
                    if run is not None:
                        if run_is_first or open_:
                            opened(held)
                        else:
                            out.append((run[0], *_finished(held), *(None,) * 7))
                        run_is_first = False
                    run, held, chars, open_ = (conv_id,), [], 0, False
                held.append((turn, role, text, gone))
                chars += len(text)
                if len(held) >= whole_rows or chars >= WHOLE_CHARS:
                    opened(held)
                    held, chars, open_ = [], 0, True
            yield _batch(out, columns, conv)
            out = []
    if run is not None:
        opened(held)
        yield _batch(out, columns, conv)


def _finished(rows: list[tuple]) -> tuple:
    """The result of a whole conversation."""
    rows = [r for r in rows if not r[3]]
    seen, faults = set(), []
    for _, role, text, _ in rows:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[1][:1] for r in rows]
    cost, audit = cheapest(list(zip(initials, faults, strict=True)))
    lines = repaired([(r[1], r[2]) for r in rows], audit, 0, (len(audit) - audit.count("D")) % 2 == 1)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), _illegal(initials), cost, audit, hashlib.sha256((lines or "").encode("utf-8", "surrogatepass")).hexdigest())


_BLOCKS = "block long, illegal long, first string, last string, costs array<long>, audits array<string>"


def _blocks(conv: pa.DataType):
    """Best cost and audit from every state to every state of one block, in an array of 16."""
    def make(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        initials, faults = group.column("initial").to_pylist(), group.column("fault").to_pylist()
        costs, audits = [], []
        for start in range(4):
            tree, best = Audits(), [None] * 4
            best[start] = (0, 0)
            for initial, fault in zip(initials, faults, strict=True):
                best = tree.after(best, initial, fault)
            costs += [x and x[0] for x in best]
            audits += [x and tree.text(x[1]) for x in best]
        return pa.table({"conv_id": group.column("conv_id")[:1].combine_chunks(), "block": group.column("block")[:1].combine_chunks(),
                         "illegal": pa.array([_illegal(initials)], pa.int64()), "first": pa.array(initials[:1], pa.string()),
                         "last": pa.array(initials[-1:], pa.string()), "costs": pa.array([costs], pa.list_(pa.int64())),
                         "audits": pa.array([audits], pa.list_(pa.string()))})
    return make


_FOLDED = "block long, illegal long, cost long, audit string, before long, has_system boolean"


class _Fold:
    """Blocks of one conversation in order. A state's audit is a chain ``(chain before, block, part of the audit)``."""

    def __init__(self):
        self.best = [(0, None), None, None, None]
        self.illegal, self.last = 0, None

    @staticmethod
    def _smaller(x, y) -> bool:
        """Compare two chains over the same blocks, from where they part."""
        parts = []
        while x is not y:
            parts.append((x[2], y[2]))
            x, y = x[0], y[0]
        return next((a < b for a, b in reversed(parts) if a != b), False)

    def add(self, block: int, illegal: int, first: str, last: str, costs: list, audits: list) -> None:
        self.illegal += illegal + (0 if self.last is None else _illegal([self.last, first]))
        self.last, out = last, [None] * 4
        for start, have in enumerate(self.best):
            for end in range(4):
                cost = costs[4 * start + end]
                if have is None or cost is None:
                    continue
                new = (have[0] + cost, (have[1], block, audits[4 * start + end]))
                if out[end] is None or new[0] < out[end][0] or new[0] == out[end][0] and self._smaller(new[1], out[end][1]):
                    out[end] = new
        self.best = out

    def rows(self, conv_id) -> list[tuple]:
        """A row per block with its part of the audit, and one without block for the conversation."""
        ends = []
        for state, tail in ((NOTHING, ""), (SYSTEM, "II"), (USER, "I"), (ASSISTANT, "")):
            if self.best[state]:
                ends.append((self.best[state][0] + INSERT * len(tail), self.best[state][1], tail))
        least = min(c for c, *_ in ends)
        spelled = []
        for _, chain, tail in (e for e in ends if e[0] == least):
            parts, more = [], tail
            while chain is not None:
                parts.append((chain[1], chain[2] + more))
                chain, more = chain[0], ""
            parts.reverse()
            spelled.append(("".join(p for _, p in parts), parts))
        audit, parts = min(spelled)
        out, before, has_system = [(conv_id, None, self.illegal, least, audit, None, None)], 0, (len(audit) - audit.count("D")) % 2 == 1
        for block, part in parts:
            out.append((conv_id, block, None, None, part, before, has_system))
            before += len(part) - part.count("D")
        return out


def _fold(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    run, fold = None, None
    for batch in batches:
        out = []
        for conv_id, *block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if run is None or run[0] != conv_id:
                if run is not None:
                    out += fold.rows(run[0])
                run, fold = (conv_id,), _Fold()
            fold.add(*block)
        yield _batch(out, _FOLDED, conv)
    if run is not None:
        yield _batch(fold.rows(run[0]), _FOLDED, conv)


def _block_lines(group: pa.Table) -> pa.Table:
    group = group.sort_by("at")
    first = group.slice(0, 1).to_pylist()[0]
    lines = repaired(zip(group.column("role").to_pylist(), group.column("text").to_pylist(), strict=True),
                     first["audit"], first["before"], first["has_system"])
    return pa.table({"conv_id": group.column("conv_id")[:1].combine_chunks(), "block": group.column("block")[:1].combine_chunks(),
                     "lines": pa.array([lines], pa.string())})


def _hash_in_order(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    run, state, any_line, columns = None, None, False, "repaired_sha256 string"
    for batch in batches:
        out = []
        for conv_id, lines in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if run is None or run[0] != conv_id:
                if run is not None:
                    out.append((run[0], state.hexdigest()))
                run, state, any_line = (conv_id,), hashlib.sha256(), False
            lines = lines.as_py()
            if lines is not None:
                state.update((("\n" if any_line else "") + lines).encode("utf-8", "surrogatepass"))
                any_line = True
        yield _batch(out, columns, conv)
    if run is not None:
        yield _batch([(run[0], state.hexdigest())], columns, conv)


def _by_blocks(rows: DataFrame, conv: pa.DataType, kind: str) -> DataFrame:
    """Results of conversations whose rows lie in several ranges or are many."""
    same = lambda a, b: a["conv_id"].eqNullSafe(b["_conv"])
    mine = lambda df: df.withColumnRenamed("conv_id", "_conv")
    block = (F.col("at") - F.col("at") % BLOCK).alias("block")
    there = rows.filter("not gone")
    # the first row with a role and text: a join on the very row, so that no repeated text makes a heavy key
    firsts = mine(there.groupBy("conv_id", "key").agg(F.min("at").alias("_at"))).select("_conv", "_at")
    narrow = there.select("conv_id", "at", block, "turn", F.substring("role", 1, 1).alias("initial"), "fault")
    judged = narrow.join(firsts, same(narrow, firsts) & (F.col("at") == F.col("_at")), "left")
    fault = F.when((F.col("fault") == "blank").eqNullSafe(True), F.lit("blank")).when(F.col("_at").isNull(), F.lit("duplicate")).otherwise(F.col("fault"))
    judged = settle(judged.select("conv_id", "at", "block", "turn", "initial", fault.alias("fault")))

    turns = judged.filter("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    counts = judged.groupBy("conv_id").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    blocks = judged.select("conv_id", "block", "at", "initial", "fault").groupBy("conv_id", "block").applyInArrow(
        _blocks(conv), f"conv_id {kind}, {_BLOCKS}")
    folded = settle(blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(
        lambda b: _fold(b, conv), f"conv_id {kind}, {_FOLDED}"))

    parts = mine(folded.filter("block is not null").select("conv_id", F.col("block").alias("_block"), "audit", "before", "has_system"))
    texts = there.select("conv_id", block, "at", "role", "text")
    lines = (texts.join(parts, same(texts, parts) & (F.col("block") == F.col("_block"))).select(
        "conv_id", "block", "at", "role", "text", "audit", "before", "has_system").groupBy("conv_id", "block")
        .applyInArrow(_block_lines, f"conv_id {kind}, block long, lines string"))
    hashed = (lines.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "lines")
              .mapInArrow(lambda b: _hash_in_order(b, conv), f"conv_id {kind}, repaired_sha256 string"))

    out = rows.select("conv_id").distinct()
    for found in (turns, counts, folded.filter("block is null").select("conv_id", "illegal", "cost", "audit"), hashed):
        found = mine(found)
        out = out.join(found, same(out, found), "left").drop("_conv")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair(rows: DataFrame, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation of ``damaged`` rows."""
    conv = pa.int64() if rows.schema["conv_id"].dataType.simpleString() == "bigint" else pa.string()
    kind = "long" if conv == pa.int64() else "string"
    keys = ["conv_id", "turn", "tie", "row", "copy"]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        F.col("conv_id").cast(kind).alias("conv_id"), "turn", "role", "text", "gone")
    read = settle(ranged.mapInArrow(lambda b: _read_range(b, conv, whole_rows), f"conv_id {kind}, {_COUNTS}, {_ROWS}"))
    done = read.filter("at is null").select("conv_id", *[c.split(" ")[0] for c in _COUNTS.split(", ")])
    return done.unionByName(_by_blocks(read.filter("at is not null").select("conv_id", *[c.split(" ")[0] for c in _ROWS.split(", ")]), conv, kind))


def repair_drill(conversations: DataFrame, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """Damage conversations by a rule of their ids, and repair them: one row for every conversation, dropped ones too.

    A null role or text counts as one space, a null turn comes first and is no gap, rows without a conv_id are one conversation.
    Rows of one turn are ordered by the SHA-256 of role and text; equal rows are interchangeable. A conversation
    without rows, before or after, has zeros, an empty audit and the hash of nothing. Columns other than conv_id, turn, role and text
    are not read. An empty table gives no rows. A conversation of any length is repaired whole.
    """
    return repair(damaged(conversations), whole_rows)


def _oracle() -> str:
    more = lambda s, cost, edit: f"printf('%09d', left({s}, 9)::INT + {cost}) || substr({s}, 10) || '{edit}'"
    ahead = ("n0", "n1", "n3")
    kept = lambda s, initial: f"CASE WHEN ok AND initial = '{initial}' THEN {more(s, 'extra', 'K')} END"
    rerole = lambda s: f"CASE WHEN ok THEN {more(s, '1 + extra', 'R')} END"
    to_user = ", ".join(f"{kept(s, 'u')}, {rerole(s)}" for s in ahead)
    inserted = f"""s0 AS n0, s1 AS n1, least(s2, {more('s0', 5, 'I')}, {more('s1', 5, 'I')}, {more('s3', 5, 'I')}) AS n2,
        least(s3, {more(f"least(s2, {more('s0', 5, 'I')}, {more('s1', 5, 'I')}, {more('s3', 5, 'I')})", 5, 'I')}) AS n3"""
    return f"""
WITH RECURSIVE r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
c AS (SELECT conv_id, turn, sha256(role || ':' || text) AS tie, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM r WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, copy) AS i, left(role, 1) AS initial FROM c),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM o),
j AS (SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS ok, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM f),
t AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM j GROUP BY conv_id),
w AS (SELECT conv_id, 0 AS i, '000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM t
  UNION ALL
  SELECT conv_id, i, {more('n0', 2, 'D')}, least({more('n1', 2, 'D')}, {kept('n0', 's')}), least({more('n2', 2, 'D')}, {to_user}),
      least({more('n3', 2, 'D')}, {kept('n2', 'a')}, {rerole('n2')})
  FROM (SELECT w.conv_id, j.i, j.ok, j.extra, j.initial, {inserted} FROM w JOIN j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = w.i + 1)),
e AS (SELECT t.conv_id, least(n0, n3) AS best FROM (SELECT conv_id, i, {inserted} FROM w) x
    JOIN t ON t.conv_id IS NOT DISTINCT FROM x.conv_id AND t.n = x.i),
a AS (SELECT conv_id, substr(best, 10) AS audit, unnest(string_split(substr(best, 10), '')) AS edit,
    generate_subscripts(string_split(substr(best, 10), ''), 1) AS p FROM e),
b AS (SELECT *, count(*) FILTER (edit <> 'I') OVER g AS i, count(*) FILTER (edit <> 'D') OVER g AS line,
    count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) % 2 AS has_system FROM a WINDOW g AS (PARTITION BY conv_id ORDER BY p)),
z AS (SELECT b.conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (line - 1 - has_system) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS said
    FROM b LEFT JOIN j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND b.i = j.i WHERE edit IN ('K', 'R', 'I') GROUP BY b.conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit,
    sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN t ON q.conv_id IS NOT DISTINCT FROM t.conv_id
LEFT JOIN e ON q.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN z ON q.conv_id IS NOT DISTINCT FROM z.conv_id"""


ORACLE = _oracle()

"""Conversation repair against enumeration and against plain string dynamic programming."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from wardflow.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, audit string, at long, key string"
WHITE = " \t\n\x0b\x0c\r"


def test_audits_compare_as_strings():
    rng, tree = random.Random(1), cr.Audits()
    nodes = [0]
    for _ in range(600):
        nodes.append(tree.add(rng.choice(nodes[-40:]), rng.choice("DK")))
    for x, y in itertools.product(rng.sample(nodes, 60), repeat=2):
        assert tree.less(x, y) == (tree.text(x) < tree.text(y))


def test_hash_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(cr, "_MOD", 3)
    test_audits_compare_as_strings()


def _enumerated(rows):
    """Cheapest edits by trying all of them."""
    best, most = None, 2
    for edits in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(range(most + 1), repeat=len(rows) + 1):
            audit, said, cost = "", "", 0
            for k, n in enumerate(gaps):
                for _ in range(n):
                    audit, cost = audit + "I", cost + 5
                    said += "a" if said.endswith("u") else "u"
                if k == len(rows):
                    break
                (initial, fault), edit = rows[k], edits[k]
                audit += edit
                if edit == "D":
                    cost += 2
                    continue
                if fault in ("blank", "duplicate"):
                    cost += 10**6
                cost += (edit == "R") + 5 * (fault == "truncated")
                said += (("a" if said.endswith("u") else "u") if edit == "R" else initial or "?")
            if re.fullmatch("(s?(ua)+)?", said) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_cheapest_equals_enumeration():
    rng = random.Random(2)
    for _ in range(40):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.choice([None, None, None, "blank", "duplicate", "truncated"]))
                for _ in range(rng.randint(0, 4))]
        assert cr.cheapest(rows) == _enumerated(rows)


def _plain(rows):
    """The result of one conversation, with audits as plain strings."""
    told = []
    for turn, role, text, key in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        tie = hashlib.sha256(f"{role}:{text}".encode()).hexdigest()
        changed = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        for copy in ([] if kind == 0 else [0, 1] if kind == 3 else [0]):
            told.append(((turn is not None, turn or 0, tie, copy), turn, "user" if kind == 4 else role, changed))
    told = [t[1:] for t in sorted(told, key=lambda t: t[0])]
    seen, faults = set(), []
    for _, role, text in told:
        bare = text.rstrip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    best = {"": (0, "", [])}  # state: last role letter said, "" for none
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    smaller = lambda out, state, new: out.__setitem__(state, min(out.get(state, new), new))

    def insert(now):
        out = dict(now)
        for _ in range(2):
            for state, (cost, audit, lines) in list(out.items()):
                name = "user" if follow[state] == "u" else "assistant"
                smaller(out, follow[state], (cost + 5, audit + "I", lines + [f"{name}:"]))
        return out

    for (_, role, text), fault in zip(told, faults):
        out = {}
        for state, (cost, audit, lines) in insert(best).items():
            smaller(out, state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more, target = 5 * (fault == "truncated"), follow[state]
            if role[:1] == target or role[:1] == "s" and state == "":
                smaller(out, role[:1], (cost + more, audit + "K", lines + [f"{role}:{text}"]))
            smaller(out, target, (cost + 1 + more, audit + "R", lines + [f"{'user' if target == 'u' else 'assistant'}:{text}"]))
        best = out
    cost, audit, lines = min(v for k, v in insert(best).items() if k in ("", "a"))
    turns = {t for t, *_ in told if t is not None}
    letters = [r[:1] for _, r, _ in told]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(x + y not in ("su", "ua", "au") for x, y in zip(letters, letters[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _conversations(rng):
    texts = ["Hello.", "Well, yes!", "And then", "", "  \n", "é ü?", "Done. ", "..", None, "Again.", "a b c."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User", None]
    rows = []
    for conv in [None, *range(60)]:
        turn = rng.randint(-2, 3)
        for k in range(rng.randint(1, 12)):
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[k % 2]
            rows.append((conv, None if rng.random() < 0.05 else turn, role, rng.choice(texts) if rng.random() < 0.6 else f"Line {k}."))
            turn += rng.choice([0, 1, 1, 1, 1, 3])
    for k in range(900):  # one conversation with nearly all rows
        rows.append((777, k, ("user", "assistant")[k % 2] if rng.random() < 0.9 else "system", rng.choice(texts) if k % 5 == 0 else f"Part {k}."))
    rows += [(800, 0, "user", "word " * 100_000 + "."), (800, 1, "assistant", "Ok.")]
    rows += [(900, 5, "user", "Same.")] * 40
    return rows


@pytest.mark.parametrize("whole_rows", [2048, 8])
def test_drill_equals_plain_code(spark, whole_rows):
    rng = random.Random(3)
    rows = _conversations(rng)
    rng.shuffle(rows)
    expected = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        expected.setdefault(conv, []).append((turn, role, text, key))
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    found = cr.repair_drill(docs, whole_rows).collect()
    assert len(found) == len(expected)
    for row in found:
        assert tuple(row)[1:] == _plain(expected[row.conv_id]), row.conv_id


def test_nothing_and_only_dropped(spark):
    assert cr.repair_drill(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(c for c in range(500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row, = cr.repair_drill(spark.createDataFrame([(gone, 0, "user", "Hi.", "", 1, "")], SCHEMA)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())

"""Prefix hashes against plain comparison of texts."""

import hashlib
import random

from wardflow.llm.prefix_hash import Excerpt, Hashed, edited_text, fingerprints, likeness

SCHEMA = "doc_id long, text string, fingerprint string, part int, first boolean"


def _word(rng):
    return "".join(rng.choice("abcdeéß😀") for _ in range(rng.randint(1, 7)))


def _text(rng, words):
    return " ".join(_word(rng) for _ in range(words))


def test_spans_and_common_extensions():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(2))
        x, y = Hashed(a), Hashed(b)
        for _ in range(30):
            i, j = rng.randrange(len(a)), rng.randrange(len(b))
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            assert x.common_extension(i, y, j) == k
            m = rng.randint(0, min(len(a) - i, len(b) - j))
            assert (x.span(i, i + m) == y.span(j, j + m)) == (a[i:i + m] == b[j:j + m])


def test_shared_arrays_equal_fresh_ones():
    rng = random.Random(2)
    for words in (0, 1, 2, 5, 60):
        a, b = _text(rng, words), _text(rng, rng.randint(0, 60))
        text, same = edited_text(a, b)
        assert str(Hashed(text, Hashed(a), same).excerpt()) == str(Hashed(text).excerpt())
        assert str(Excerpt.read(str(Hashed(text).excerpt()))) == str(Hashed(text).excerpt())


def test_excerpt_has_the_smallest_windows():
    rng = random.Random(3)
    for text in [_text(rng, 300), "ab" * 4000, "a" * 5000, "x" * 2000 + _text(rng, 100) + "x" * 2000, "abc", ""]:
        own = Hashed(text)
        first = {}
        for at, value in enumerate(own.windows.tolist()):
            first.setdefault(value, at)
        assert own.excerpt().anchors["at"].tolist() == sorted(first[v] for v in sorted(first)[:16])


def test_likeness_follows_what_is_shared():
    rng = random.Random(4)
    like = lambda a, b: likeness(Hashed(a).excerpt(), Hashed(b).excerpt())
    for words in (10, 40, 400, 4000):
        a, b = _text(rng, words), _text(rng, words)
        assert like(a, a) == 1 and like(a, b) < 0.15
        assert 0.55 < like(a, edited_text(a, b)[0]) < 0.9
        if words > 10:
            assert like("New beginning. " + a, a) > 0.8
            assert like(a, a[:len(a) // 2] + " one more word " + a[len(a) // 2:]) > 0.7
    assert like("", "") == 1 and like("", "a") == 0 and like("abcd", "abcx") == 0.75


def _expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (doc, text) in enumerate(order):
        own, following = text or "", order[(k + 1) % len(order)][1] or ""
        changed = edited_text(own, following)[0]
        x, y, z = (Hashed(t).excerpt() for t in (own, changed, following))
        out.append((doc, len(own), hashlib.sha256(changed.encode()).hexdigest(), str(x), str(y), likeness(x, y), likeness(x, z)))
    return out


def test_fingerprints_of_a_table(spark):
    rng = random.Random(5)
    rows = [(i * 3 - 50, _text(rng, rng.randint(0, 80))) for i in range(200)]
    rows += [(1000, None), (1001, ""), (1002, "short"), (2**63 - 1, _text(rng, 30_000)), (-2**63, "a" * 50_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "x", 1, True) for r in rows], SCHEMA).repartition(5)
    key = lambda r: str(r[0])
    assert sorted([tuple(r) for r in fingerprints(docs).collect()], key=key) == sorted(_expected(rows), key=key)


def test_repeated_and_null_ids(spark):
    rows = [(5, f"text {i} of one id") for i in range(50)] + [(None, "no id"), (None, None), (5, "text 0 of one id")]
    found = fingerprints(spark.createDataFrame([(*r, "x", 1, True) for r in rows], SCHEMA)).collect()
    assert sorted(str((r.doc_id, r.fingerprint)) for r in found) == sorted(str((d, str(Hashed(t or "").excerpt()))) for d, t in rows)
    assert all(0 <= r.near_next <= 1 for r in found)


def test_one_row_and_none(spark):
    one = fingerprints(spark.createDataFrame([(1, "only this text here", "x", 1, True)], SCHEMA)).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []

"""Exact and near duplicates, decontamination, packing and id files against plain code on small fixtures."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardflow.llm import decontaminate, exact_dedup, near_join, packing, token_ids
from wardflow.llm.common import vocabulary

SCHEMA = "doc_id long, text string, id long, key string, bare string, n string, kept string, node string, token string, tokens string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 7, "k", "b", "n", "x", "y", "z", "w") for i, t in rows], SCHEMA).repartition(3)


LONG = " ".join(f"w{k}" for k in range(30_000))
ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  two"), (6, "One\ntwo "), (7, "O n e two"), (8, LONG), (9, LONG + " "),
        (10, "é à"), (11, "é à"), (11, "é à"), (None, "stray"), (12, "a\x0bb")]


def expected_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), 2**62 if i is None else i))
    out = []
    for bare, members in groups.items():
        keep, used = min(members), False
        for m in sorted(members):
            first = m == keep and not used
            used |= first
            out.append((None if m[1] == 2**62 else m[1], None if keep[1] == 2**62 else keep[1], len(members), first, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.digest128, lambda text: F.unhex(F.substring(F.md5(text), 1, 2)), lambda text: F.unhex(F.lit("00"))])
def test_exact_groups_also_when_digests_collide(spark, digest):
    rows = [r for r in ROWS if digest is exact_dedup.digest128 or r[0] != 11 or r is not ROWS[10]]
    got = sorted([tuple(r) for r in exact_dedup.exact_groups(frame(spark, rows), digest=digest).collect()], key=str)
    want = expected_exact(rows)
    if digest is not exact_dedup.digest128:  # rows given twice are one document among colliding ones
        got, want = sorted(set(got), key=str), sorted(set(want), key=str)
        got, want = [g for g in got if g[0] != 11], [w for w in want if w[0] != 11]
    assert got == want


def test_exact_keeps_columns_and_copes_with_nothing(spark):
    docs = frame(spark, ROWS)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    # 3 has most white space of the empty ones, 6 is longest of "One two", 9 of the long ones, 10 the smallest of a tie
    assert sorted([r.doc_id or -1 for r in kept.collect()]) == [-1, 3, 5, 7, 9, 10, 12]
    assert exact_dedup.exact_groups(docs.limit(0)).collect() == []


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and label[b] < label[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a], changed = label[b], True
    return {i: (len(s), label[i]) for i, s in sets.items()}


def near_rows(seed=3, groups=6, copies=25):
    rng = np.random.default_rng(seed)
    shared, rows = [f"common{k}" for k in range(30)], []
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(rng.integers(40, 120))]
        for _ in range(int(rng.integers(2, copies))):
            words = list(base)
            for _ in range(int(rng.integers(0, 8))):
                words[int(rng.integers(len(words)))] = f"x{rng.integers(10**9)}"
            rows.append(" ".join(words + (shared if rng.random() < 0.3 else [])))
    rows += [" ".join(shared), " ".join(shared), "A b c", "a B c", "a b", "", None, "  ", "ONE two three four FIVE", "one two three four five six"]
    rows += [" ".join(f"own{k}_{j}" for j in range(30)) + " " + " ".join(shared) for k in range(40)]
    order = rng.permutation(len(rows))
    return [(int(i), rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("small", [2, 16])
def test_components_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(near_join, "SMALL", small)
    rows = near_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_join.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_join_of_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (3, None), (4, LONG), (9, LONG.upper())]
    got = sorted([tuple(r) for r in near_join.near_duplicates(frame(spark, rows)).collect()], key=str)
    assert got == sorted([(5, 2, 5, 5), (5, 2, 5, 5), (None, 2, 5, 5), (3, 0, 3, 3), (4, 29996, 4, 4), (9, 29996, 4, 4)], key=str)
    assert near_join.near_duplicates(frame(spark, rows).limit(0)).collect() == []


def test_shingle_hashes_tell_words_apart():
    assert len(near_join.shingles("a bc d e f")) == 1
    assert set(near_join.shingles("ab c d e f")).isdisjoint(near_join.shingles("a bc d e f"))
    assert list(near_join.shingles("Ab\x0bC")) == list(near_join.shingles(" aB c\n")) and len(near_join.shingles("É")) == 1
    assert set(near_join.shingles("É")) != set(near_join.shingles("é"))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_contamination(docs, items, n=10):
    out = []
    for i, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for item, text in items:
            q = plain_words(text)
            for k in range(max(1, len(q) - n + 1) if q else 0):
                win = q[k:k + n]
                for at in range(len(w) - len(win) + 1):
                    if w[at:at + len(win)] == win:
                        hit |= set(range(at, at + len(win)))
                        found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    words = ["the", "of", "and", "a", "x1", "été", "to"]
    say = lambda n: " ".join(rng.choice(words, n))
    items = [(k, say(int(rng.integers(1, 16)))) for k in range(8)] + [(100, None), (101, "!!"), (102, "the the the the the the the the the the the"), (2, say(12))]
    docs = [(k, say(int(rng.integers(0, 60)))) for k in range(40)] + [(200, None), (201, ""), (202, "...  "), (7, say(30)), (None, "THE, the-the the the the the the the the")]
    docs += [(300 + k, f"Foo {t} bar") for k, (_, t) in enumerate(items) if t]
    made = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, window string")
    extra = spark.createDataFrame([(i, t, "d", 1) for i, t in docs], "doc_id long, text string, doc string, pos int").repartition(2)
    got = sorted([tuple(r) for r in decontaminate.contamination(extra, made).collect()], key=str)
    assert got == brute_contamination(docs, items)
    assert decontaminate.contamination(extra.limit(0), made).collect() == []
    assert all(not r.contaminated for r in decontaminate.contamination(extra, made.limit(0)).collect())


def test_proximity_finds_scattered_terms(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "gamma x x alpha x beta"), (3, "alpha x x x x x x x x beta gamma")], "doc_id long, text string")
    terms, _ = decontaminate.windows(spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string"))
    vocabulary_ = terms.select("word").distinct().withColumn("term", F.monotonically_increasing_id())
    vocabulary_ = spark.createDataFrame(vocabulary_.collect(), vocabulary_.schema)
    index = decontaminate.build_index(docs, vocabulary_)
    phrases = terms.join(vocabulary_, "word").select("window", "size", "offset", "term")
    ids = {r.doc: r.doc_id for r in index.filter("term = -1").collect()}
    assert {ids[r.doc] for r in decontaminate.proximity_matches(index, phrases, 5).collect()} == {1, 2}
    assert {ids[r.doc] for r in decontaminate.phrase_matches(index, phrases).collect()} == {1}


def plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            min(fits)[0] -= n
        else:
            bins.append([capacity - n])
    return sorted(b[0] for b in bins)


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for capacity in (1, 10, 37):
        for _ in range(30):
            lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 120))).tolist()
            counts = {n: lengths.count(n) for n in set(lengths)}
            bins, placed = {}, {}
            for length, first, n, start, each, offset in packing.plan(counts, capacity):
                for k in range(n):
                    bins.setdefault(start + k // each, []).append((offset + k % each * length, length))
                placed[length] = placed.get(length, 0) + n
            assert placed == counts
            for parts in bins.values():
                at = 0
                for offset, length in sorted(parts):
                    assert offset == at
                    at += length
            assert sorted(capacity - sum(n for _, n in p) for p in bins.values()) == plain_best_fit(lengths, capacity)


def test_packed_pieces_are_whole(spark):
    path, library = vocabulary("byte_bpe_50k.json"), Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = [(1, None), (2, ""), (3, "word " * 5000), (3, "word " * 5000), (None, "x y <|endoftext|> z"), *[(10 + k, "a b c " * k) for k in range(60)]]
    got = packing.pack(frame(spark, rows), path).collect()
    texts = {i: t for i, t in rows}
    for doc in texts:
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2], "<u4")
        mine = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == doc})
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024), len(ids)]
        assert mine == [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist() and sum(n for _, n in parts) <= 1024
    assert packing.pack(frame(spark, rows).limit(0), path).collect() == []


def test_id_files_round_trip(spark, tmp_path):
    path, library = vocabulary("word_bpe_49k.json"), Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    rows = [(5, None), (2, "Hello WORLD"), (9, LONG), (7, "a <|endoftext|> B<|STARTOFTEXT|>"), (1, "ΣΑΣ İ"), (None, "first"), (4, "tie"), (4, "other tie")]
    out = str(tmp_path / "ids")
    got = [tuple(r) for r in token_ids.written_positions(frame(spark, rows), path, out).collect()]
    texts, start = {i: t for i, t in rows}, 0
    for doc, at, n, crc in sorted(got, key=lambda r: r[1]):
        assert at == start
        start += n
        if doc != 4:
            ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2], "<u4")
            assert (n, crc) == (len(ids), zlib.crc32(ids.tobytes()))
    order = [d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order == [None, 1, 2, 4, 4, 5, 7, 9]
    one = token_ids.read_ids(spark, out).filter("doc_id = 2")
    assert one.first().ids[-1] == 2 and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,2)]" in one._jdf.queryExecution().toString()
    assert token_ids.written_positions(frame(spark, rows).limit(0), path).collect() == []

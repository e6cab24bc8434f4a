"""The manifest against a plain recursive tree."""

import hashlib
import zlib

from wardflow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, leaf string, grp string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    said = [row[0], row[1], row[2], row[3], text]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in said])


def _tree(nodes):
    """Root, and per node its (before, after) siblings on every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        for k, place in enumerate(at):
            run, slot = runs[place // 8], place % 8
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[k] = place // 8
        nodes = [_h(*run) for run in runs]
    return nodes[0], paths


def _expected(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, _leaf(row, row[4]), row))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = [_tree([leaf for *_, leaf, _ in sorted(langs[x], key=lambda y: y[:3])]) for x in order]
    root, above = _tree([t[0] for t in trees])
    out = []
    for lang, (subroot, paths), up in zip(order, trees, above):
        for (_, _, leaf, row), path in zip(sorted(langs[lang], key=lambda y: y[:3]), paths):
            fold = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                fold = _leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            for pre, post in [*path, *up]:
                fold = _h(pre, fold, post)
            out.append((row[0], leaf, subroot, root, _h(*[p + q for p, q in [*path, *up]]), fold, fold == root))
    return out


def _check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = merkle.manifest(docs).drop("n_levels")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted(_expected(rows), key=key)


def test_manifest_equals_plain_tree(spark):
    long = "Ä word. " * 20_000
    rows = [(i, "web", ["en", "de", "fr"][i % 3], 10, f"Text {i} é") for i in range(230)]
    rows += [(None, None, None, None, None), (None, "a", "en", 1, ""), (7, "web", "en", 1, "again"), (7, "web", "en", 1, "again"),
             (-5, "web", "", 3, long), (2**63 - 1, "web", "zz", 3, "A"), (-2**63, "1:x", "en", None, "B")]
    rows += [(1000 + i, "s", f"lang{i}", 1, "C") for i in range(70)]  # more languages than one run holds
    _check(spark, rows)


def test_one_hot_language(spark):
    _check(spark, [(i, "s", "en", 1, "T") for i in range(600)])


def test_one_row_and_none(spark):
    _check(spark, [(6, "s", "en", 1, "Some Text")])
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty).count() == 0


def test_tampering_is_noticed(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, "UPPER" if i % 2 else "lower", "", "") for i in range(90)], SCHEMA)
    for row in merkle.manifest(docs).collect():
        assert row.verified == (row.doc_id % 2 == 0 or zlib.crc32(str(row.doc_id).encode()) % 3 != 0)

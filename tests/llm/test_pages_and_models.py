"""Web archives, page texts, the quality model, personal data and the pipeline."""

import io
import random
import re
import zipfile

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from wardflow.llm import html_text, pii, quality, warc_zip

PAGE_SCHEMA = "page_id long, url string, html string, text string, main string, host string, key string"


def pages_frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "m", "h", "k") for i, u, h in rows], PAGE_SCHEMA).repartition(2)


# ---- archives ----

BIG, OTHER = "<p>é</p>" * 200, "<p>x</p>" * 300
PAGES = [(1, "http://a/1", BIG), (5, "http://a/5", BIG), (3, None, BIG), (4, "http://a/\r\n4", OTHER), (9, "http://b", None), (8, "http://b", ""), (7, "u", "tiny"),
         (6, "u", "tiny"), (None, "http://n", "no id"), (2, "http://c", "\r\n\r\nWARC/1.1\r\n\x00")]


def test_archive_round_trip(spark, tmp_path):
    got = {r.page_id: r for r in warc_zip.archive_pages(pages_frame(spark, PAGES), str(tmp_path / "out")).collect()}
    assert len(got) == len(PAGES)
    for page, _, body in PAGES:
        r, raw = got[page], (body or "").encode()
        assert r.payload_bytes == len(raw) and r.payload_digest == __import__("hashlib").sha1(raw).hexdigest()
        later = page in (1, 3)
        assert (r.record_type, r.refers_to) == (("revisit", 5) if later else ("response", None))
        assert (r.payload is None) if later else bytes(r.payload) == raw
    assert got[3].url is None and got[4].url == "http://a/%0D%0A4"
    assert warc_zip.archive_pages(pages_frame(spark, PAGES).limit(0)).collect() == []


def test_zip64_directories_are_followed(tmp_path):
    """A package whose 32-bit fields are all saturated, as in archives over 4 GB."""
    import struct
    body, name = b"stored bytes", b"archive/data.warc.gz"
    local = b"PK\x03\x04" + struct.pack("<HHHHHLLLHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    central = b"PK\x01\x02" + struct.pack("<HHHHHHLLLHHHHHLL", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(local) + len(body)
    end64 = b"PK\x06\x06" + struct.pack("<QHHLLQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = b"PK\x06\x07" + struct.pack("<LQL", 0, at + len(central), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHLLH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    path = tmp_path / "big.zip"
    path.write_bytes(local + body + central + end64 + locator + end)
    with warc_zip.open_package(str(path)) as file:
        start, size = warc_zip.members(file)[name.decode()]
        assert file.read_at(size, start) == body


def test_foreign_zip_lists_stored_members_alone():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("indexes/index.cdxj", "line")
        z.writestr("squeezed", "x" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"note"
    file = pa.BufferReader(raw.getvalue())
    found = warc_zip.members(file)
    assert list(found) == ["indexes/index.cdxj"] and file.read_at(4, found["indexes/index.cdxj"][0]) == b"line"
    with pytest.raises(ValueError):
        warc_zip.members(pa.BufferReader(b"not a zip"))


# ---- page texts ----

def template(n, body):
    return (f'<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style></head><body><header class="site"><a href="/">Home</a></header><nav><ul><li><a>one</a><li><a>two</a></ul></nav>'
            f'<div id="cookie-notice"><p>We use cookies</div><div class="layout"><div class="col-{n} story"><h1>Head {n} &amp; co</h1>{body}<form><input><button>Send</button></form></div>'
            f'<div class="sidebar"><p>Most read</p></div></div><section class="comments"><p>First!</p></section><footer>&copy; x</footer><script>var a="<p>no</p>";</script>')


def test_article_is_cut_out_by_the_host_wrapper(spark):
    bodies = ["<p>One <b>two</b>\n three<p>Four", "<p>Only", "<ul><li>a<li>b &lt;c&gt;</ul><p>A &am B &eacute;", "", "<div class='ad'>buy</div><p>x<br>y</p>"]
    rows = [(k, "https://News.example.org:80/p", template(k, b)) for k, b in enumerate(bodies)]
    rows += [(50, None, "<article><p>in</p></article><p>out</p>"), (51, "x", None), (52, "http://b/", ""), (53, "http://b/", "plain &amp text <"), (0, "https://news.example.org", rows[0][2])]
    got = [tuple(r) for r in html_text.main_texts(pages_frame(spark, rows)).select("page_id", "text", "n_chars").collect()]
    want = {0: "Head 0 & co\nOne two three\nFour", 1: "Head 1 & co\nOnly", 2: "Head 2 & co\na\nb <c>\nA &am B é", 3: "Head 3 & co", 4: "Head 4 & co\nx\ny",
            50: "in", 51: "", 52: "", 53: "plain & text <"}
    assert sorted(got) == sorted([(k, t, len(t)) for k, t in want.items()] + [(0, want[0], len(want[0]))])
    made = {r.host: r for r in html_text.wrappers(pages_frame(spark, rows)).collect()}
    assert made["news.example.org"].pages == 6 and "(<p>#</p>)*" in made["news.example.org"].expression
    assert html_text.main_texts(pages_frame(spark, rows).limit(0)).collect() == []


def test_streams_align_into_optional_and_repeated_groups():
    wrap = lambda *sources: html_text.expression(__import__("functools").reduce(html_text.merged, [html_text.page_wrapper(html_text.Page(s)) for s in sources])["e"])
    assert wrap("<div><p>a</div>", "<div><p>a<p>b</div>") == "<div>(<p>#</p>)+</div>"
    assert wrap("<div><h1>t</h1><p>a</div>", "<div><p>a</div>") == "<div>(<h1>#</h1>)?<p>#</p></div>"
    assert wrap("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "<dl>(<dt>#</dt><dd>#</dd>)+</dl>"
    assert wrap("<div></div>", "<div><p>x<p>y</div>") == "<div>(<p>#</p>)*</div>"


def test_broken_markup_ends():
    for source in ["<p title='x>never closed", "<!-- open", "<script>x", "</p></div>", "<" * 1000, "<a" * 2000, "&" * 500, "<p>" * 3000 + "deep", "<div>" * 900 + "x", "'\"<b '\">t"]:
        page = html_text.Page(source)
        page.text(())
    assert html_text.Page("<p>a</p>b<p>c").text(()) == "a\nb\nc"


# ---- quality ----

def test_rules_separate_and_compile_to_the_same_score(spark):
    rng = random.Random(2)
    words = ["the", "river", "carried", "old", "boats", "slowly", "home", "again"]
    good = lambda: " ".join(rng.choices(words, k=rng.randint(5, 60))) + "."
    bad = lambda: rng.choice([lambda: " ".join(w + "$$$" for w in rng.choices(words, k=20)), lambda: "BUY NOW!! " * 9, lambda: " | ".join(words), lambda: "old old old old " * 9])()
    rows = [(k, good() if k % 3 else bad(), int(k % 3 > 0)) for k in range(900)] + [(5000, None, 1), (5001, "", 0)]
    docs = spark.createDataFrame([(i, t, "s", 1.0, ["w"]) for i, t, _ in rows], "doc_id long, text string, stats string, score double, _words array<string>")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(3, None, 0), (99999, 1, 0)], "doc_id long, quality int, text int")
    got = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    import zlib
    assert {i for i, r in got.items() if r.held_out} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out and i < 5000]
    assert np.mean([p == y for p, y in held]) > 0.97 and all(0 <= r.score <= 1 for r in got.values())
    model = quality.train(docs, labels)
    told = quality.with_statistics(docs.select("doc_id", "text")).select("doc_id", "stats.*").toPandas()
    plain = dict(zip(told["doc_id"], model.score(told[quality.STATISTICS].to_numpy(float))))
    assert all(abs(plain[i] - r.score) < 1e-9 for i, r in got.items())
    empty = quality.scored(docs.limit(0), labels)
    assert empty.collect() == [] and {r.score for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}


# ---- personal data ----

def test_base_matches_equal_the_patterns():
    rng, parts = random.Random(1), ["a", "b.", "_", "@", "x-y", ".", ".com", "1", "23", "256", "255", "+", "(", ")", " ", "-", "4111111111111111", "é", "٣", "%"]

    def plain(x):
        out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
        out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m.group().split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
            d = re.sub("[^0-9]", "", m.group())
            out += [(m.start(), m.end(), "card")] if 14 <= len(d) <= 19 and pii.luhn(d) else []
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x):
            out += [(m.start(), m.end(), "phone")] if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15 else []
        return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2]), s[1]))

    for _ in range(8000):
        x = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert pii.base_spans(x) == plain(x), repr(x)


def test_field_gradient_is_that_of_the_likelihood():
    zone, truth = "mail bo@ex.org or +1 202 555 0143", [(5, 14, "email"), (18, 33, "phone")]
    field = pii.SemiCRF({"email|ats:1": 0.7, "phone|plus:True": 0.5})
    value, grad = field.gradient(zone, truth)
    for name in list(grad)[:25]:
        moved = pii.SemiCRF({**field.weights, name: field.weights.get(name, -4.0 if name.endswith("bias") else 0.0) + 1e-5})
        assert abs((moved.gradient(zone, truth)[0] - value) / 1e-5 - grad[name]) < 1e-2


def test_personal_data_of_odd_rows(spark):
    rng = random.Random(5)
    texts = [f"Write to user{k}@site{k % 7}.org or call +1 202 555 {rng.randint(1000, 9999)} from 10.0.{k}.{k % 200}, room {k}, year 20{k % 90 + 10}." for k in range(120)]
    field = pii.fit(texts)
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, texts[0], "x"), (3, texts[0], "x"), (None, "é a(at)b.org, bo@ex.org", "x"), (4, "7 " * 50_000 + "+" + "9" * 20_000, "x")],
                                 "doc_id long, text string, spans string")
    got = pii.personal_data(docs, field).collect()
    assert len(got) == 6 and all(set(r.base) <= set(r.spans) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].spans == [] and by[2].spans == [] and {s.kind for s in by[3].base} == {"email", "phone", "ip"}
    assert [texts[0][s.start:s.end] for s in by[3].base][0] == "user0@site0.org"
    assert {(s.start, s.end) for s in by[None].spans} >= {(14, 23)}
    assert pii.personal_data(docs.limit(0), field).collect() == []
    clean = {r.doc_id: r.text for r in pii.redacted(docs, field).collect()}
    assert "[email]" in clean[3] and clean[1] is None and clean[2] == ""
    found = sum({(s.start, s.end, s.kind) for s in by[3].base} <= {tuple(s) for s in pii.SemiCRF(field.weights).best(texts[0][a:b])} for a, b in [(0, len(texts[0]))])
    assert found == 1


# ---- pipeline ----

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_stages_do_what_they_say(spark):
    from wardflow.llm.common import table
    docs = table(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    kept, out = set(texts), docs
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    from test_documents import brute_components, brute_contamination
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.settle(stage(spark, out, FOLDER))
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        rows = [(i, texts[i]) for i in kept]
        if name == "best-fit packing":
            assert ids == kept
            continue
        assert out.columns == docs.columns
        gone = kept - ids
        if name == "quality classifier":
            known = [i for i in kept if i in labels]
            assert np.mean([(i in ids) == bool(labels[i]) for i in known]) > 0.95
        elif name == "exact dedup":
            bare = {}
            for i, t in rows:
                bare.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
            assert ids == {min(v)[1] for v in bare.values()}
        elif name == "n-gram Jaccard join":
            assert ids == {c for _, c in brute_components(rows).values()}
        else:
            items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
            assert gone == {r[0] for r in brute_contamination(rows, items) if r[5]}
        kept = ids

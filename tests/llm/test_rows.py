"""Stages of the pipeline on rows that share an id or have none."""

import zlib

from pyspark.sql import functions as F

import corpus_pipeline
from wardflow.llm import exact_dedup, near_join


def test_stages_decide_per_row_where_ids_repeat_or_are_null(spark, monkeypatch):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = lambda out: sorted([(r.doc_id, r.text) for r in out.collect()], key=str)
    copies = [(None, "same text"), (None, "same  text"), (7, "x y"), (7, "x y"), (7, "other"), (None, "stray"), (9, None), (8, None)]
    kept = [(None, "same  text"), (7, "x y"), (7, "other"), (None, "stray"), (8, None)]
    assert texts(corpus_pipeline.no_exact_copies(spark, frame(copies), "")) == sorted(kept, key=str)
    every = exact_dedup.exact_groups(frame(copies).withColumn("r", F.monotonically_increasing_id()), digest=lambda text: F.unhex(F.lit("00")), row_col="r")
    assert every.filter("kept").count() == 5 and every.count() == 8

    words = lambda name: " ".join(f"{name}{k}" for k in range(60))
    near = [(None, words("a")), (None, words("a") + " more"), (2, words("a") + " less"), (None, words("b")), (None, words("b") + " more"), (5, words("c")),
            (5, words("c") + " more"), (5, words("d")), (None, ""), (None, ""), (6, None)]
    out = texts(corpus_pipeline.no_near_copies(spark, frame(near), ""))
    assert len(out) == 7 and [t for _, t in out].count("") == 2 and (6, None) in out
    assert {(i, t.split()[0]) for i, t in out if t} == {(2, "a0"), (None, "b0"), (5, "c0"), (5, "d0")}

    leak = words("leak")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: spark.createDataFrame([(1, leak)], "item_id long, text string"))
    found = corpus_pipeline.no_benchmark_text(spark, frame([(None, "clean one"), (None, leak), (3, "clean two"), (3, "so " + leak)]), "")
    assert texts(found) == [(3, "clean two"), (None, "clean one")]


EXTREME = [2**62, 2**62 + 5, 2**63 - 1, -2**63, 0, None]


def test_ids_of_any_value(spark):
    """Ids at the ends of their range and null are told apart, null coming last."""
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(i, words) for i in EXTREME] + [(i, f"{words} {i}") for i in EXTREME[:3]] + [(2**62 + 7, "  "), (None, ""), (None, "only null ids here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r.doc_id), r.component_id, r.class_id) for r in near_join.near_duplicates(docs).collect() if r.n_shingles > 1)
    assert found == sorted([(str(i), -2**63, -2**63) for i in EXTREME] + [(str(i), -2**63, i) for i in EXTREME[:3]])
    groups = exact_dedup.exact_groups(docs)
    assert sorted(str(r.doc_id) for r in groups.filter("keep_id = -9223372036854775808").collect()) == sorted(map(str, EXTREME))
    assert {r.doc_id for r in groups.filter("text_sha256 = sha2('', 256) and kept").collect()} == {2**62 + 7}
    colliding = exact_dedup.exact_groups(docs, digest=lambda text: F.unhex(F.lit("00")))
    assert sorted(map(str, colliding.collect())) == sorted(map(str, groups.collect()))
    assert exact_dedup.keep_one(docs).count() == 6


def test_what_the_quality_fit_holds_is_bounded_by_its_labels(spark, monkeypatch):
    """20,000 rows of one id are one lesson, whatever they say; repeated labels count once."""
    from pyspark.sql import functions as F

    from wardflow.llm import quality
    held = []
    monkeypatch.setattr(quality, "fit_rules", lambda x, y: held.append((x, list(y))))
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(3, "other words"), (4, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (4, 0), (None, 1), (9, 1)], "doc_id long, quality int")
    quality.train(docs, labels, max_rows=100)
    x, y = held[0]
    assert len(x) == len(y) == len({i for i in (1, 3, 4) if zlib.crc32(str(i).encode()) % 4 != 2}) and len(x) > 1


def test_ids_of_one_document_id_are_cut_into_ranges(spark, tmp_path):
    """20,000 rows that share an id are written by several tasks, in one order, and read back whole."""
    from pyspark.sql import functions as F

    from wardflow.llm import token_ids
    from wardflow.llm.common import vocabulary
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("row "), F.col("id").cast("string")).alias("text"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # would make one task of so few rows
    spark.conf.set(merging, "false")
    token_ids.write_ids(docs.repartition(4), str(tmp_path / "ids"), vocabulary("word_bpe_49k.json"))
    spark.conf.set(merging, "true")
    read = token_ids.read_ids(spark, str(tmp_path / "ids"))
    per_shard = [r["n"] for r in read.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert sum(per_shard) == 20_000 and len(per_shard) > 1
    at = sorted((r["start"], r["n_tokens"]) for r in token_ids.positions(read).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(at, at[1:])) and at[0][0] == 0

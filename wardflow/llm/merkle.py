"""Merkle manifest of a dataset by slot pivots: conditional aggregates spread the children of a parent into ``FANOUT`` columns.

Concatenating the columns of a parent and hashing them gives its digest; leaving a child's own column out gives that child's
siblings. Trees grow bottom up, one aggregation per level, each an eighth of the one before; proofs come top down, each parent
handing its children the siblings above them, so that a leaf never looks its ancestors up one by one. One tree per language, then
one over the languages' roots. Only DataFrame functions run, and only digests are shuffled: texts are hashed where they are read.

Leaves are placed within a language by range partitions of (lang, doc_id), so a language with a third of all rows, or with all of
them, spreads over as many tasks as its rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import ascii_lower, crc32_sql
from wardflow.session import settle

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Siblings of one level around the own slot.
STEP = "struct<pre:string,post:string>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value; so no two rows of values give the same text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column) -> Column:
    """Digest of a row whose text is ``text``."""
    return F.sha2(F.concat(*[field(text if c == "text" else F.col(c)) for c in FIELDS]), 256)


def tampered_id() -> Column:
    """Rows that are altered to show that a manifest notices."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, grp, leaf, offered`` of every row; ``offered`` is the digest of the row as it is presented for a check.

    ``grp`` is the language so written that null comes first and the rest in UTF-8 order.
    """
    rows = docs.select(*[F.col(c).alias(c) for c in FIELDS]).select("*", leaf(F.col("text")).alias("leaf"))
    return rows.select("doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("grp"), "leaf",
                       F.when(tampered_id(), leaf(ascii_lower(F.col("text")))).otherwise(F.col("leaf")).alias("offered"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with ``pos`` (from 0, by ``order`` within ``grp``) and ``n``, the rows of their group.

    Range partitions give the order; a place is the distance to the first row of the group in its partition, shifted by
    what earlier partitions hold of the group: one row per partition and group.
    """
    sorted_rows = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    laid = settle(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    firsts = laid.groupBy("grp", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = firsts.select("grp", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(Window.partitionBy("grp")).alias("n"))
    return (laid.withColumn("_part", part).join(shifts, ["grp", "_part"])
            .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before"))


def _runs(nodes: DataFrame) -> DataFrame:
    """One row per run of ``FANOUT`` nodes: its number ``pos`` in the level above, and ``c0 ..`` of what the nodes hold."""
    slot = F.col("pos") % FANOUT
    spread = [F.max(F.when(slot == i, F.col("node"))).alias(f"c{i}") for i in range(FANOUT)]
    runs = nodes.filter("n > 1").groupBy("grp", F.floor(F.col("pos") / FANOUT).alias("pos")).agg(F.max("n").alias("n"), *spread)
    return settle(runs.withColumn("n", F.ceil(F.col("n") / FANOUT)).withColumn(
        "digest", F.sha2(F.concat_ws("", *[f"c{i}.digest" for i in range(FANOUT)]), 256)))


def grown(nodes: DataFrame) -> list[DataFrame]:
    """The runs of every level, lowest first, of all groups; ``nodes`` are ``grp, pos, n, node`` with ``node.digest``."""
    levels, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(_runs(nodes))
        nodes = levels[-1].select("grp", "pos", "n", F.struct("digest").alias("node"))
        most = -(-most // FANOUT)
    return levels


def tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``grp, digest`` of the one node that is left of each group."""
    left = nodes.filter("n = 1").select("grp", "node.digest")
    for runs in levels:
        left = left.unionByName(runs.filter("n = 1").select("grp", "digest"))
    return left


def handed_down(nodes: DataFrame, levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """``grp, node, above`` of every bottom node; ``above.path`` has its siblings level by level, then what ``roots`` hands down.

    ``roots`` are ``grp, above`` with ``above.path`` an array of ``STEP``.
    """
    below = None
    for runs in reversed(levels):
        met = runs.filter("n = 1").join(roots, "grp")
        if below is not None:
            inner = runs.filter("n > 1").join(below.select("grp", "pos", "above"), ["grp", "pos"])
            met = met.unionByName(inner)
        digests = [f"c{i}.digest" for i in range(FANOUT)]
        step = lambda i: F.struct(F.concat_ws("", *digests[:i]).alias("pre"), F.concat_ws("", *digests[i + 1:]).alias("post"))
        children = F.array(*[F.struct((F.col("pos") * FANOUT + i).alias("pos"), F.col(f"c{i}").alias("node"), step(i).alias("step"))
                             for i in range(FANOUT)])
        below = (met.select("grp", "above", F.explode(children).alias("child")).filter("child.node is not null")
                 .select("grp", "child.pos", "child.node",
                         F.col("above").withField("path", F.concat(F.array("child.step"), "above.path")).alias("above")))
    alone = nodes.filter("n = 1").select("grp", "node").join(roots, "grp")
    return alone if below is None else alone.unionByName(below.select("grp", "node", "above"))


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["pre"], s["post"])), ""), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings give."""
    return F.aggregate(path, digest, lambda have, s: F.sha2(F.concat(s["pre"], have, s["post"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, n_levels, verified`` of every row.

    A null in any column is written ``-``; null doc_ids come first in their language and are never tampered with. Rows that share
    a doc_id follow one another by digest, equal rows in any order. Columns beyond ``FIELDS`` are not read. An empty table
    gives no rows. A dataset of one row has that leaf as its root and an empty proof.
    """
    found = placed(leaves(docs), "doc_id", "leaf")
    nodes = settle(found.select("grp", "pos", "n", F.struct(F.col("leaf").alias("digest"), "doc_id", "offered").alias("node")))
    levels = grown(nodes)
    per_lang = settle(tops(nodes, levels).withColumnRenamed("grp", "lang_grp").withColumn("grp", F.lit("all")))
    top_nodes = settle(placed(per_lang, "lang_grp").select("grp", "pos", "n", F.struct("digest", "lang_grp").alias("node")))
    top_levels = grown(top_nodes)
    root = settle(tops(top_nodes, top_levels))
    nothing = F.array().cast(f"array<{STEP}>")
    above_all = root.select("grp", F.struct(F.col("digest").alias("root"), F.lit("").alias("subroot"), nothing.alias("path")).alias("above"))
    lang_roots = handed_down(top_nodes, top_levels, above_all).select(
        F.col("node.lang_grp").alias("grp"), F.col("above").withField("subroot", F.col("node.digest")).alias("above"))
    proven = handed_down(nodes, levels, settle(lang_roots))
    path = F.col("above.path")
    out = proven.select("node.doc_id", F.col("node.digest").alias("leaf"), "above.subroot", "above.root",
                        proof_digest(path).alias("proof_sha256"), folded(F.col("node.offered"), path).alias("folded_root"),
                        F.size(path).cast("long").alias("n_levels"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int = 7, top_levels: int = 3) -> str:
    """The same in SQL, with as many levels as 8**7 rows of a language and 8**3 languages need."""
    enc = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    row = lambda t: "sha256(" + " || ".join(enc(t if c == "text" else c) for c in FIELDS) + ")"
    crc = crc32_sql("doc_id::VARCHAR")
    parts = [f"""l AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS grp,
        {row('text')} AS leaf, CASE WHEN coalesce({crc} % 3 = 0, false) THEN {row(low)} ELSE {row('text')} END AS offered FROM documents)""",
             """d AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l)""",
             """n0 AS (SELECT grp, pos, leaf AS digest, count(*) OVER (PARTITION BY grp) AS n FROM d)""",
             "p0 AS (SELECT rid, grp, pos, leaf, '' AS sib, offered AS fold FROM d)"]

    def climb(n: str, p: str, upto: int) -> None:
        for k in range(upto):
            parts.append(f"""{n}r{k} AS (SELECT grp, pos // 8 AS up, list(digest ORDER BY pos) AS ds, any_value(n) AS n FROM {n}{k} GROUP BY ALL)""")
            parts.append(f"""{n}{k + 1} AS (SELECT grp, up AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS digest,
                (n + 7) // 8 AS n FROM {n}r{k})""")
            parts.append(f"""{p}{k + 1} AS (SELECT rid, q.grp, q.pos // 8 AS pos, leaf,
                CASE WHEN n > 1 THEN sib || array_to_string(ds[1:q.pos % 8], '') || array_to_string(ds[q.pos % 8 + 2:8], '') ELSE sib END AS sib,
                CASE WHEN n > 1 THEN sha256(array_to_string(ds[1:q.pos % 8], '') || fold || array_to_string(ds[q.pos % 8 + 2:8], ''))
                     ELSE fold END AS fold FROM {p}{k} q JOIN {n}r{k} r ON q.grp = r.grp AND q.pos // 8 = r.up)""")

    climb("n", "p", levels)
    parts.append(f"s AS (SELECT grp AS lang_grp, digest, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM n{levels})")
    parts.append("t0 AS (SELECT 'all' AS grp, pos, digest, n FROM s)")
    parts.append(f"u0 AS (SELECT rid, 'all' AS grp, s.pos, leaf, sib, fold FROM p{levels} p JOIN s ON p.grp = s.lang_grp)")
    climb("t", "u", top_levels)
    return "WITH " + ",\n".join(parts) + f"""
SELECT d.doc_id, d.leaf, s.digest AS subroot, t.digest AS root, sha256(u.sib) AS proof_sha256, u.fold AS folded_root,
       u.fold = t.digest AS verified
FROM d JOIN u{top_levels} u USING (rid) JOIN s ON d.grp = s.lang_grp CROSS JOIN t{top_levels} t"""


ORACLE = _oracle()

"""Near duplicates: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and their components.

Two sets that are so similar must share tokens among the first few of each under any global order of tokens. That is asked
under several orders, and a pair is compared in full only if it passes all of them:

* order A, by token hash, needs no statistics: documents without enough tokens that any other document has in its
  A-prefix are out, at the cost of a quarter of the tokens;
* order B, rarest first by exact document frequency among those left, makes pairs: a prefix of rare tokens is shared by few;
* order C, by a second hash, and A once more, are checked per pair before the intersection.

Equal sets are one node. Groups of thousands of near copies share all tokens, and their pairs are never listed: in a bucket
of more than ``SMALL`` documents each is compared with a hub, then what is not yet connected with a dozen further hubs a round, and
only pairs that are still in different components are compared directly, less those that sizes and places of their first common token, or distances to a
common hub (the Jaccard distance is a metric), rule out. So no link that would join two components is missed. Components and links
stay distributed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import discard, settle

SHINGLE = 5
SMALL = 16
HUB_ROUNDS = 4
HUBS = 12
SETS = "doc_id long, n int, sig binary, tokens array<long>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text, by array arithmetic on its bytes.

    Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Fewer than five words are one shingle; none, an empty set.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate([[False], ~_IS_SPACE[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[raw] + np.uint64(1)) * up[:-1])])
    word = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    size = min(SHINGLE, len(word))
    total = np.full(len(word) - size + 1, size, np.uint64)
    for k in range(size):
        total = _mixed(total * _BASE + word[k:len(word) - size + 1 + k])
    return np.unique(total)


# Prefix lengths. A partner of a set of n tokens shares at least ceil(0.8 n) of them.
def _least(n: Column) -> Column:
    return F.floor((n * 4 + 4) / 5).cast("int")


def _k(n: Column) -> Column:
    """How many tokens of their extended prefixes a pair must share, for the smaller size n."""
    return F.greatest(F.lit(1), F.floor((n + 19) / 20).cast("int"))


def _prefix(n: Column) -> Column:
    return F.least(n, n - _least(n) + _k(n))


def _signature(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _prefix_sets(docs: DataFrame) -> DataFrame:
    """``SETS`` of every row: size and signature of its set, and the A-prefix of its tokens; then its ``row``, if it has one."""
    more = docs.columns[2:]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part, found = batch.slice(at, 128), []
                for text in part.column(1).to_pylist():
                    tokens = shingles(text)
                    n = len(tokens)
                    found.append((n, _signature(tokens), tokens[:min(n, n - (4 * n + 4) // 5 + max(1, (n + 19) // 20))]))
                offsets = np.cumsum([0, *[len(t) for _, _, t in found]], dtype=np.int32)
                flat = np.concatenate([t for _, _, t in found]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([n for n, _, _ in found], pa.int32()), pa.array([s for _, s, _ in found], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), *part.columns[2:]], ["doc_id", "n", "sig", "tokens", *more])

    return docs.mapInArrow(make, ", ".join([SETS, *[f"{c} long" for c in more]]))


def _shared_tokens(sets: DataFrame) -> DataFrame:
    """``token, node, n, df`` of the tokens that more than one set has.

    Counts are combined before they are shuffled, and the join is left to Spark, which splits a token that very many sets have.
    """
    dealt = sets.select("node", "n", F.explode("tokens").alias("token"))
    counts = dealt.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    return dealt.join(counts.hint("merge"), "token")


def candidates(docs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, n, tokens`` of the sets that pass order A: they share at least ceil(0.04 n) tokens of their A-prefix.

    A class is met again at its first row: by number where rows have one, else by id. ``sets`` is used up.
    """
    at, of = ("row", "first_row") if "row" in docs.columns else ("doc_id", "first")
    first = (sets.join(classes.select("node", F.col("sig").alias("_sig"), F.col(of).alias("_first")).hint("merge"),
                       (F.col("sig") == F.col("_sig")) & F.col(at).eqNullSafe(F.col("_first")))
             .select("node", "n", "tokens").filter("n > 0"))
    enough = (_shared_tokens(first).groupBy("node", "n").agg(F.count("*").alias("shared"))
              .filter(F.col("shared") >= F.greatest(F.lit(1), F.floor((F.col("n") + 24) / 25))))
    chosen = settle(enough.select("node").join(classes.hint("merge"), "node").select("node", F.col("sig").alias("class"), F.col(of).alias("_first")))
    discard(sets)
    texts = docs.join(chosen.hint("merge"), F.col(at).eqNullSafe(F.col("_first")))
    out = settle(texts.select("text", "node", "class").mapInArrow(_class_sets, "node long, n int, tokens array<long>"))
    discard(chosen)
    return out


def _class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets of ``text, node, class`` rows whose text has the class's set; of rows given twice the first in a row."""
    last = None
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            nodes, sizes, sets = [], [], []
            for text, node, sig in zip(*[c.to_pylist() for c in batch.slice(at, 128).columns], strict=True):
                tokens = shingles(text)
                if node != last and _signature(tokens) == sig:
                    last = node
                    nodes.append(node)
                    sizes.append(len(tokens))
                    sets.append(tokens)
            if nodes:
                offsets = np.cumsum([0, *sizes], dtype=np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
                                                  pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["node", "n", "tokens"])


def buckets(sets: DataFrame) -> DataFrame:
    """``token, node, n, pos``: each set under the tokens of its B-prefix that others have, with their place in order B.

    Tokens of one set alone come first in order B and make no bucket; where they fill the prefix the set has no partner.
    """
    ranked = (_shared_tokens(sets).groupBy("node", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("common"))
              .withColumn("take", F.size("common") - _least(F.col("n")) + 1).filter("take > 0"))
    return settle(ranked.select("node", "n", (F.col("n") - F.size("common")).alias("alone"),
                                F.posexplode(F.slice("common", 1, F.col("take"))).alias("at", "t"))
                  .select("t.token", "node", "n", (F.col("alone") + F.col("at")).alias("pos")))


def _may_link() -> Column:
    """Whether sizes and places allow a link between sets a and b that have a token at ``pos_a`` and ``pos_b`` of order B.

    Asked of their first common token: before it nothing is shared, so they share at most what is left from it on, and must
    share 4/9 of the sum of their sizes. A pair that fails there fails in later buckets too, and a linked pair passes there.
    """
    left = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    return (left * 9 >= (F.col("n_a") + F.col("n_b")) * 4) & (F.least("n_a", "n_b") * 5 >= F.greatest("n_a", "n_b") * 4)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, distance, linked`` of distinct pairs; pairs that orders A and C rule out are not intersected (distance null)."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"t_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    order_c = lambda s: F.transform(F.slice(F.array_sort(F.transform(f"t_{s}", lambda t: F.struct(
        F.xxhash64(t, F.lit(1)).alias("h"), t.alias("t")))), 1, _prefix(F.col(f"n_{s}"))), lambda x: x["t"])
    order_a = lambda s: F.slice(f"t_{s}", 1, _prefix(F.col(f"n_{s}")))
    k = _k(F.least("n_a", "n_b"))
    passes = ((F.size(F.array_intersect(order_a("a"), order_a("b"))) >= k)
              & (F.size(F.array_intersect(order_c("a"), order_c("b"))) >= k))
    met = F.when(passes, F.size(F.array_intersect("t_a", "t_b")))
    union = F.col("n_a") + F.col("n_b") - F.col("met")
    return settle(both.select("a", "b", "n_a", "n_b", met.alias("met")).select(
        "a", "b", (F.lit(1.0) - F.col("met") / union).alias("distance"),
        F.coalesce(F.col("met") * 100 >= union * 80, F.lit(False)).alias("linked")))


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) by label propagation with pointer jumping; every round is written out."""
    both = settle(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    rounds = [settle(nodes.select("node", F.col("node").alias("component")))]
    while True:
        labels = rounds[-1].select("node", "component")
        heard = (both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("heard")))
        lower = labels.join(heard.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.col("component").alias("was"), F.least("component", F.coalesce("heard", "component")).alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        rounds.append(settle(lower.join(jump, "component", "left").select(
            "node", "was", F.least("component", F.coalesce("further", "component")).alias("component"))))
        discard(*rounds[:-1])
        if rounds[-1].filter("component <> was").isEmpty():
            out = settle(rounds[-1].select("node", "component"))
            discard(both, rounds[-1])
            return out


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after more edges: only edges between different components count, and only components are relabelled."""
    at = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    between = settle(edges.select("a", "b").join(at("a"), "a").join(at("b"), "b").filter("c_a <> c_b").select(
        F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b")).distinct())
    if between.isEmpty():
        return labels
    tops = components(between, between.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    renamed = tops.select(F.col("node").alias("component"), F.col("component").alias("top"))
    out = settle(labels.join(renamed, "component", "left").select("node", F.coalesce("top", "component").alias("component")))
    discard(between, labels, tops)
    return out


def connected(sets: DataFrame) -> DataFrame:
    """``node, component`` of candidate sets."""
    near = buckets(sets)
    counted = settle(near.join(near.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").hint("merge"), "token"))
    discard(near)
    few, many = counted.filter(F.col("c") <= SMALL), counted.filter(F.col("c") > SMALL)
    other = few.select("token", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"))
    listed = (few.withColumnsRenamed({"node": "a", "n": "n_a", "pos": "pos_a"}).join(other, "token")
              .filter((F.col("a") < F.col("b")) & _may_link()).select("a", "b"))

    labels = settle(counted.select("node").distinct().select("node", F.col("node").alias("component")))
    checked, open_ = None, many
    for turn in range(HUB_ROUNDS):
        placed = open_.join(labels, "node")
        if turn == 0:
            pool = placed
        else:  # hubs of later rounds come from the component that most of a bucket is in
            largest = (placed.groupBy("token", "component").agg(F.count("*").alias("m")).groupBy("token")
                       .agg(F.max(F.struct("m", "component")).alias("top")).select("token", F.col("top.component").alias("top")))
            placed = placed.join(largest, "token")
            pool, placed = placed.filter("component = top"), placed.filter("component <> top")
        chance = Window.partitionBy("token").orderBy(F.xxhash64("node", F.lit(turn)))
        hubs = pool.withColumn("nth", F.row_number().over(chance)).filter(F.col("nth") <= (1 if turn == 0 else HUBS)).select(
            "token", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"))
        stars = (placed.withColumnsRenamed({"node": "a", "n": "n_a", "pos": "pos_a"}).join(hubs, "token")
                 .filter((F.col("a") != F.col("b")) & _may_link())
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        pairs = (listed.union(stars) if turn == 0 else stars).distinct()
        if checked is not None:
            pairs = pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        seen = verified(pairs, sets)
        earlier, checked = checked, seen if checked is None else settle(checked.union(seen))
        labels = merged(labels, seen.filter("linked"))
        if earlier is not None:
            discard(earlier, seen)
        rest = settle(_still_apart(open_, labels))
        discard(open_, *([counted] if turn == 0 else []))
        open_ = rest
        if open_.isEmpty():
            return labels
    seen = verified(_across(open_.join(labels, "node"), checked), sets)
    return merged(labels, seen.filter("linked"))


def _still_apart(many: DataFrame, labels: DataFrame) -> DataFrame:
    """Large buckets whose sets are in different components."""
    apart = (many.join(labels, "node").groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low <> high").select("token"))
    return many.join(apart, "token", "left_semi")


def _across(open_: DataFrame, checked: DataFrame) -> DataFrame:
    """Pairs of a large bucket that are still in different components, less those that a common hub rules out."""
    largest = (open_.groupBy("token", "component").agg(F.count("*").alias("m")).groupBy("token")
               .agg(F.max(F.struct("m", "component")).alias("top")).select("token", F.col("top.component").alias("top")))
    open_ = open_.join(largest, "token")
    hub = open_.groupBy("token").agg(F.min(F.struct(F.xxhash64("node", F.lit(0)).alias("h"), "node")).alias("hub")).select("token", F.col("hub.node").alias("hub"))
    known = checked.filter("distance is not null")
    far = known.select("a", "b", "distance").union(known.select("b", "a", "distance")).toDF("node", "hub", "distance")
    open_ = settle(open_.join(hub, "token").join(far, ["node", "hub"], "left"))
    side = lambda df, x: df.select("token", F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("pos").alias(f"pos_{x}"),
                                   F.col("component").alias(f"c_{x}"), F.col("distance").alias(f"d_{x}"))
    possible = F.coalesce(F.abs(F.col("d_a") - F.col("d_b")) <= 0.2 + 1e-9, F.lit(True))
    return (side(open_.filter("component <> top"), "a").join(side(open_, "b"), "token")
            .filter((F.col("c_a") != F.col("c_b")) & _may_link() & possible)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(checked.select("a", "b"), ["a", "b"], "left_anti"))


def near_duplicates(docs: DataFrame, row_col: str | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` of every row.

    ``class_id`` is the smallest id with the same set; ``component_id`` the smallest reachable by links. Documents without words
    (null, empty, white space) link with nothing. Rows that share an id are classified each by its own text, and a null id is null
    in the result and comes after all others. Tokens are 64-bit hashes: within a pair two shingles meet by chance with a probability under 1e-10.

    Where ``row_col`` numbers the rows, it is returned too, and so is ``component``: a number that no two components share, even if
    their ids do; null without words.
    """
    row = [] if row_col is None else ["row"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       *[F.col(row_col).cast("long").alias(r) for r in row])
    sets = settle(_prefix_sets(docs))
    slim = settle(sets.drop("tokens"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *row)).alias("first")
    classes = settle(slim.filter("n > 0").groupBy("sig").agg(least).select(
        "sig", F.col("first.doc_id").alias("first"), *[F.col("first.row").alias("first_row") for _ in row],
        F.monotonically_increasing_id().alias("node")))
    chosen = candidates(docs, classes, sets)
    # Nodes are numbered without regard to ids, so a component takes the smallest id among its classes.
    grouped = settle(connected(chosen).join(classes, "node").select("sig", "component", "first"))
    discard(chosen)
    lowest = grouped.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("no_id"), "first")).alias("lowest"))
    whole = ["component"] if row else []
    found = grouped.join(lowest, "component").select("sig", F.col("lowest.first").alias("component_id"), *whole)
    by_sig = settle(classes.join(found, "sig", "left").select(  # a component of rows without id has none, like its classes
        F.col("sig"), F.col("first").alias("class_id"), F.coalesce("component_id", "first").alias("component_id"),
        *[F.coalesce(c, "node").alias(c) for c in whole]))
    discard(grouped, classes)
    alone = F.col("n") == 0
    return (slim.join(by_sig, "sig", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    *[F.col(r).alias(row_col) for r in row], *whole))

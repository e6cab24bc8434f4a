"""Benchmark decontamination over a distributed positional inverted index of the training documents.

The index holds a row (term, document, position) for every occurrence of a benchmark term in a training document; other terms
can be part of no match and are left out while the index is built. A phrase is searched from its rarest terms on: the lists of
its three rarest terms, each shifted by the term's offset in the phrase, are intersected first, and only documents where
that leaves a start have the lists of the other terms intersected as well. Only DataFrame functions run.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is ``n`` consecutive words of an item, or all
words of an item that has fewer. Rows of the input are documents of their own, also where ids repeat; null text has no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import ascii_lower
from wardflow.session import settle

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
RAREST = 3
END = "\x00"  # no word holds it: the entry after a document's last word, whose position is the number of words


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def windows(items: DataFrame, n: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows as ``window, size, offset, word`` rows, and which items have them as ``window, item_id`` rows."""
    w = F.col("words")
    at = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
    each = (items.select(F.col("item_id"), words(F.col("text")).alias("words")).filter(F.size("words") > 0)
            .select("item_id", F.explode(F.transform(at, lambda i: F.slice(w, i + 1, n))).alias("phrase")).distinct())
    numbered = settle(each.select("phrase").distinct().select("phrase", F.monotonically_increasing_id().alias("window")))
    of_items = settle(each.join(numbered, "phrase").select("window", "item_id"))
    terms = settle(numbered.select("window", F.size("phrase").alias("size"), F.posexplode("phrase").alias("offset", "word")))
    return terms, of_items


def build_index(docs: DataFrame, vocabulary: DataFrame, row_col: str | None = None) -> DataFrame:
    """``term, doc, pos`` of every occurrence of the words in ``vocabulary`` (``word, term``).

    Each input row gets a number ``doc``, that of ``row_col`` if given; its row with ``term`` -1 carries ``doc_id`` and, as ``pos``, the number of words.
    The vocabulary joins without a hint: Spark broadcasts it if its size allows and shuffles otherwise.
    """
    spark = docs.sparkSession
    known = vocabulary.unionByName(spark.createDataFrame([(END, -1)], "word string, term long"))
    known = settle(known.coalesce(1))
    number = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    entries = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), number.alias("doc"))
               .select("doc", "doc_id", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "word")))
    return settle(entries.join(known, "word").select(
        "term", "doc", "pos", F.when(F.col("term") == -1, F.col("doc_id")).alias("doc_id")))


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``window, doc, start, size`` of every occurrence of ``window, size, offset, term`` phrases."""
    posted = index.filter("term >= 0").select("term", "doc", "pos")
    rarity = posted.groupBy("term").agg(F.count("*").alias("n"))
    ranked = (phrases.join(rarity, "term", "left").fillna(0, ["n"])
              .withColumn("nth", F.row_number().over(Window.partitionBy("window").orderBy("n", "offset")))
              .withColumn("least", F.min("n").over(Window.partitionBy("window"))).filter("least > 0"))
    ranked = settle(ranked.select("window", "size", "offset", "term", "nth").coalesce(1))

    def shifted(postings: DataFrame, roles: DataFrame) -> DataFrame:
        """Starts at which all of the roles' terms stand at their offsets."""
        need = roles.groupBy("window").agg(F.count("*").alias("need"))
        roles = roles.join(need, "window").select("window", "size", "offset", "term", "need")
        return (postings.join(roles, "term").filter("pos >= offset")
                .groupBy("doc", "window", "size", (F.col("pos") - F.col("offset")).alias("start"), "need")
                .agg(F.count("*").alias("met")).filter("met = need").select("window", "doc", "start", "size"))

    by_rarest = settle(shifted(posted, ranked.filter(F.col("nth") <= RAREST)))
    in_docs = posted.join(settle(by_rarest.select("doc").distinct()), "doc", "left_semi")
    rest = ranked.filter(F.col("nth") > RAREST)
    expected = (by_rarest.join(rest.select("window", "offset", "term"), "window")
                .select("window", "doc", "start", "size", (F.col("start") + F.col("offset")).alias("pos"), "term"))
    met = (expected.join(in_docs, ["doc", "pos", "term"]).groupBy("window", "doc", "start", "size")
           .agg(F.count("*").alias("met")).filter(F.col("met") == F.col("size") - RAREST).drop("met"))
    short = by_rarest.filter(F.col("size") <= RAREST)
    return settle(met.unionByName(short))


def proximity_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """``window, doc, near``: the rarest term stands at ``near`` and every other term within ``within`` words of it.

    Positions are bucketed by ``within``, so lists meet by equality of bucket and of its neighbours.
    """
    posted = index.filter("term >= 0").select("term", "doc", "pos")
    rarity = posted.groupBy("term").agg(F.count("*").alias("n"))
    distinct = phrases.select("window", "term").distinct().join(rarity, "term", "left").fillna(0, ["n"])
    by_window = Window.partitionBy("window")
    ranked = distinct.withColumn("nth", F.row_number().over(by_window.orderBy("n", "term"))).withColumn("terms", F.count("*").over(by_window))
    near = (posted.join(ranked.filter("nth = 1").select("term", "window", "terms"), "term")
            .select("window", "doc", "terms", F.col("pos").alias("near"))
            .withColumn("bucket", F.explode(F.array(*[F.floor(F.col("near") / within) + k for k in (-1, 0, 1)]))))
    others = posted.join(ranked.filter("nth > 1").select("term", "window"), "term").withColumn("bucket", F.floor(F.col("pos") / within))
    met = (near.join(others, ["window", "doc", "bucket"], "left")
           .withColumn("met", F.when(F.abs(F.col("pos") - F.col("near")) <= within, F.col("term")))
           .groupBy("window", "doc", "near", "terms").agg(F.count_distinct("met").alias("met")))
    return met.filter(F.col("met") == F.col("terms") - 1).select("window", "doc", "near")


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW, row_col: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document row.

    A word inside any occurrence of a window is hit. ``items_sha256`` is of the item ids with occurring windows, sorted as
    strings and joined by commas. Without items, or without words, nothing is hit. Null item ids take part as an empty id.
    Where ``row_col`` numbers the rows, it is returned too.
    """
    of_phrases, of_items = windows(items.select(F.col("item_id"), F.col("text")), n)
    vocabulary = settle(of_phrases.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term")))
    phrases = of_phrases.join(vocabulary, "word").select("window", "size", "offset", "term")
    index = build_index(docs, vocabulary, row_col)
    found = phrase_matches(index, phrases)
    hit = (found.select("doc", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
           .groupBy("doc").agg(F.count("*").alias("n_hit")))
    whose = (found.select("doc", "window").distinct().join(of_items, "window")
             .select("doc", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
             .groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items")))
    rows = index.filter("term = -1").select("doc", "doc_id", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (rows.join(hit, "doc", "left").join(whose, "doc", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
                    *[F.col("doc").alias(c) for c in [row_col] if c])
            .withColumn("contaminated", F.col("n_hit") > 0))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_HITS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
     b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
     win AS (SELECT DISTINCT item_id, words[i + 1 : i + 10] AS phrase
             FROM (SELECT item_id, words, unnest(range(0, greatest(len(words) - 9, 1))) AS i FROM b WHERE len(words) > 0)),
     sizes AS (SELECT DISTINCT len(phrase) AS n FROM win),
     grams AS (SELECT doc_id, i, n, words[i + 1 : i + n] AS gram
               FROM (SELECT doc_id, words, n, unnest(range(0, greatest(len(words) - n + 1, 0))) AS i FROM d, sizes)),
     hit AS (SELECT doc_id, i, n, item_id FROM grams JOIN win ON gram = phrase),
     per AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM hit) GROUP BY doc_id),
     its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
             FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
"""
ORACLE = _HITS + """
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN its USING (doc_id)
"""

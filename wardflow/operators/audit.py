"""Table-level quality reports.  Each returns a small DataFrame; nothing is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.functions.calendar import days
from wardflow.operators.quality import ISSUES, PASSED
from wardflow.session import settle


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_summary(silver: DataFrame, table: str, run_id: str | None = None, rows: str | None = None) -> DataFrame:
    """One row of the run log: rows in, passed and failed. ``rows``: the column that says for how many rows each one stands."""
    def counted(where: Column) -> Column:
        return F.count_if(where) if rows is None else F.coalesce(F.sum(F.when(where, F.col(rows))), F.lit(0).cast("long"))
    # The run log's column names.
    out = silver.agg(counted(F.lit(True)).alias("rows_total"), counted(F.col(PASSED)).alias("rows_passed"),
                     counted(~F.col(PASSED)).alias("rows_failed"))
    out = out.withColumn("table_name", F.lit(table))
    if run_id is not None:
        out = out.withColumns({"run_id": F.lit(run_id), "run_timestamp": F.current_timestamp()})
    return out


def gate_report(tables: Mapping[str, DataFrame], settled: bool = False) -> DataFrame:
    """``settled``: table after table, each one's shuffle files being removed before the next begins."""
    return stack([settle(out) if settled else out for out in (run_summary(df, name) for name, df in tables.items())])


def observed_gate(silver: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Gate whose row counts are collected while the result is written, without a second pass."""
    seen = Observation(name)
    watched = silver.observe(seen, F.count(F.lit(1)).alias("rows_in"),
                             F.count_if(F.col(PASSED)).alias("rows_out"))
    return watched.filter(F.col(PASSED)), seen


def blank_batches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Load audit: rows per table, and rows whose file name carried no batch date."""
    return stack([df.agg(F.count(F.lit(1)).alias("rows"),
                         F.count_if(F.coalesce(F.col("_batch_id"), F.lit("")) == "").alias("blank_batch_id"))
                  .withColumn("table_name", F.lit(name)) for name, df in tables.items()])


def issue_breakdown(silver: DataFrame, rows: str | None = None) -> DataFrame:
    """Rows per issue message. ``rows``: the column that says for how many rows each one stands."""
    return (silver.filter(~F.col(PASSED))
            .select(F.explode(F.split(ISSUES, "; ")).alias("issue"), (F.lit(1) if rows is None else F.col(rows)).alias("_rows"))
            .groupBy("issue").agg(F.sum("_rows").alias("rows")))


def null_keys(fact: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Unresolved surrogate keys of a fact, one row per key, from a single aggregate."""
    row = fact.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    pairs = F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).alias("null_rows")) for k in keys])
    return (row.select(F.explode(pairs).alias("_p"), F.col("_rows").alias("rows"))
            .select(F.lit(table).alias("table_name"), "_p.key_column", "_p.null_rows", "rows"))


def below_zero(fact: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Negative durations or amounts per column."""
    row = fact.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("negative_rows")) for c in columns])
    return (row.select(F.explode(pairs).alias("_p"))
            .select(F.lit(table).alias("table_name"), "_p.measure", "_p.negative_rows"))


@dataclass(frozen=True)
class Relation:
    """A child key that should resolve, with the orphan share above which it is worth a warning."""

    child: str
    key: str
    parent: str
    parent_key: str
    tolerance: float = 0.0


def orphan_matrix(relations: Sequence[Relation], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct orphan keys per relation, their share of the child's rows, and a verdict.

    Every child is read once, whatever the number of its relations, and so is every parent key: children's and parents'
    keys are stacked and grouped once, with partial aggregation. A group holds one count for each relation into that parent
    key and whether it is known, so nothing is joined or sorted, and a key takes one row however many relations use it.
    """
    names = [f"{r.child}.{r.key} -> {r.parent}.{r.parent_key}" for r in relations]
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame([(n, float(r.tolerance)) for n, r in zip(names, relations, strict=True)],
                                   "relation string, tolerance double")
    into: dict[tuple[str, str], list[str]] = {}
    for n, r in zip(names, relations, strict=True):
        into.setdefault((r.parent, r.parent_key), []).append(n)
    number = {parent: i for i, parent in enumerate(into)}

    def entry(parent: tuple[str, str], slot: int, key: str) -> Column:
        return F.struct(F.lit(number[parent]).alias("into"), F.lit(slot).alias("slot"), F.col(f"`{key}`").cast("string").alias("key"))
    stacked = []
    for child in dict.fromkeys(r.child for r in relations):
        pairs = [entry(p, into[p].index(n), r.key) for n, r in zip(names, relations, strict=True)
                 if r.child == child for p in [(r.parent, r.parent_key)]]
        stacked.append(tables[child].select(F.explode(F.array(*pairs)).alias("p")).select("p.*"))
    for parent in into:
        stacked.append(tables[parent[0]].select(entry(parent, -1, parent[1]).alias("p")).select("p.*").filter("key IS NOT NULL"))
    slots = range(max(len(used) for used in into.values()))
    grouped = stack(stacked).groupBy("into", "key").agg(
        F.max(F.col("slot") < 0).alias("known"), *[F.count_if(F.col("slot") == i).alias(f"_n{i}") for i in slots])
    orphan = F.col("key").isNotNull() & ~F.col("known")
    totals = grouped.groupBy("into").agg(*[F.struct(F.sum(f"_n{i}").alias("rows"), F.count_if(orphan & (F.col(f"_n{i}") > 0)).alias("orphans")).alias(f"_s{i}")
                                           for i in slots])
    place = [F.struct(F.lit(number[p]).alias("into"), F.lit(n).alias("relation"), F.col(f"_s{used.index(n)}").alias("s"))
             for p, used in into.items() for n in used]
    judged = (totals.withColumn("_p", F.explode(F.array(*place))).filter("_p.into = into")
              .select("_p.relation", "_p.s.rows", "_p.s.orphans"))
    out = listed.join(judged, "relation", "left").na.fill(0, ["rows", "orphans"])
    share = F.col("orphans") / F.greatest(F.col("rows"), F.lit(1))
    return (out.withColumn("status", F.when(share <= F.col("tolerance"), "PASS").otherwise("WARN"))
            .select("relation", "rows", "orphans", "tolerance", "status"))


# --- delivery ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Cadence:
    """When a feed is due: every day, or on one ISO weekday (1 = Monday)."""

    feed: str
    weekday: int | None = None


def expected_deliveries(spark: SparkSession, cadences: Sequence[Cadence], first: str, last: str) -> DataFrame:
    feeds = F.array(*[F.struct(F.lit(c.feed).alias("feed"), F.lit(c.weekday).cast("int").alias("weekday"))
                      for c in cadences])
    return (days(spark, first, last, "due").withColumn("_f", F.explode(feeds))
            .filter(F.col("_f.weekday").isNull() | (F.weekday("due") + 1 == F.col("_f.weekday")))
            .select(F.col("_f.feed").alias("feed"), "due",
                    F.date_format("due", "yyyyMMdd").alias("batch_id")))


def due_deliveries(cadences: Sequence[Cadence], delivered: DataFrame) -> DataFrame:
    """What each feed owed between its first and its last batch, found in ``delivered`` (feed, batch_id, ...) itself.

    Batches whose id is no yyyyMMdd day set no bound; a feed without any batch owes nothing yet. One row per feed and day.
    """
    weekday = F.try_element_at(F.create_map(*[F.lit(x) for c in cadences for x in (c.feed, c.weekday or 0)]), F.col("feed"))
    day = F.try_to_date("batch_id", "yyyyMMdd")
    spans = (delivered.groupBy("feed").agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
             .withColumn("_weekday", weekday).filter("_weekday IS NOT NULL"))
    return (spans.withColumn("due", F.explode(F.sequence("_first", "_last")))
            .filter((F.col("_weekday") == 0) | (F.weekday("due") + 1 == F.col("_weekday")))
            .select("feed", "due", F.date_format("due", "yyyyMMdd").alias("batch_id")))


def freshness(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """``missing`` (no file) against ``empty`` (a file without rows) against ``ok``.

    ``delivered`` has one row per file: feed, batch_id, rows.
    """
    seen = delivered.groupBy("feed", "batch_id").agg(F.sum("rows").alias("rows"))
    return (expected.join(seen, ["feed", "batch_id"], "left")
            .withColumn("status", F.when(F.col("rows").isNull(), "missing")
                        .when(F.col("rows") == 0, "empty").otherwise("ok")))


def delivered_files(files: DataFrame, landed: DataFrame) -> DataFrame:
    """Files found (feed, file, batch_id) with their landed row counts; 0 where none landed."""
    counts = landed.groupBy(F.col("_source_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return files.join(counts, "file", "left").na.fill(0, ["rows"])


def volume_check(delivered: DataFrame, trailing: int = 7, share: float = 0.95) -> DataFrame:
    """A batch is ``truncated`` when below ``share`` of the median of the batches before it.

    One row per feed and batch enters the window, so it is as long as the calendar.
    """
    per_batch = delivered.groupBy("feed", "batch_id").agg(F.sum("rows").alias("rows"))
    before = Window.partitionBy("feed").orderBy("batch_id").rowsBetween(-trailing, -1)
    # median is no running window function: sort the few counts in the frame instead
    recent, size = F.col("_recent"), F.size("_recent")
    middle = (F.try_element_at(recent, F.floor((size + 1) / 2).cast("int"))
              + F.try_element_at(recent, F.floor(size / 2).cast("int") + 1)) / 2
    return (per_batch.withColumn("_recent", F.sort_array(F.collect_list("rows").over(before)))
            .withColumn("usual_rows", F.when(size > 0, middle)).drop("_recent")
            .withColumn("status", F.when(F.col("rows") < F.col("usual_rows") * share, "truncated")
                        .otherwise("ok")))


# --- checks -----------------------------------------------------------------------------------

def check(df: DataFrame, name: str, ok: Column, detail: Column, bad: str = "WARN",
          unknown: str | None = None) -> DataFrame:
    """One result row from a one-row frame; NULL (not computable) gives ``unknown`` or ``bad``."""
    status = (F.when(ok.isNull(), F.lit(unknown or bad)).when(ok, F.lit("PASS")).otherwise(F.lit(bad)))
    return df.select(F.lit(name).alias("check_name"), status.alias("status"),
                     detail.cast("string").alias("detail"))


def band_check(df: DataFrame, name: str, value: str, low: float, high: float) -> DataFrame:
    return check(df, name, F.col(value).between(low, high), F.round(F.col(value), 4))


def violations(df: DataFrame, name: str, broken: Column, detail: str = "rows", bad: str = "FAIL") -> DataFrame:
    """A conditional requirement: no row may satisfy ``broken``."""
    counted = df.agg(F.count_if(broken).alias("_n"))
    return check(counted, name, F.col("_n") == 0, F.concat(F.col("_n").cast("string"), F.lit(f" {detail}")), bad)


def check_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def score_findings(findings: DataFrame, answers: DataFrame) -> DataFrame:
    """Recall and precision per defect type.

    Both frames carry (source, defect_type, row_key); the answer key is test material and never
    an input of any other table.
    """
    keys = ["source", "defect_type", "row_key"]
    found = findings.select(*keys).distinct().withColumn("_found", F.lit(1))
    planted = answers.select(*keys).distinct().withColumn("_planted", F.lit(1))
    both = found.join(planted, keys, "full")
    hit = F.count_if(F.col("_found").isNotNull() & F.col("_planted").isNotNull())
    return both.groupBy("defect_type").agg(
        F.count("_planted").alias("planted"), F.count("_found").alias("found"), hit.alias("hits"),
        F.try_divide(hit, F.count("_planted")).alias("recall"),
        F.try_divide(hit, F.count("_found")).alias("precision"))

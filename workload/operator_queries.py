"""The operators by themselves, on the supplied tables and on the event stream's batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.calendar import with_calendar
from wardflow.functions.identity import deidentify, role_view
from wardflow.functions.labels import risk_sentence
from wardflow.functions.parsing import fold, number_with_unit, to_time_by_system
from wardflow.operators import aggregates, dedupe, joins, neighbours, ordered, scd
from wardflow.operators.intervals import clip_to_days
from wardflow.operators.percentiles import exact_percentiles, medians_with
from wardflow.operators.quality import add_issue, gate
from wardflow.plans.history import History
from wardflow.session import shared_folder
from wardflow.sources.layers import Layers
from wardflow.streaming.alarms import silences
from wardflow.streaming import events as ev
from wardflow.streaming import prescriptions, vitals
from workload import oracle_tables as ot
from workload.oracle_tables import typed
from workload.queries import Hospital, present, register


def t(h: Hospital, name: str) -> DataFrame:
    """A supplied table, its zone-less timestamps read as UTC."""
    df = h.bronze.table(name)
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def cents(column: str):
    return F.col(column).cast("decimal(18,2)")


# --- deduplication and identity ---------------------------------------------------------------

_REST = "l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc"


@register("latest_line_per_key", f"""select l_orderkey, l_linenumber, l_partkey, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, {_REST}) = 1""")
def _(h):
    out = dedupe.latest_per_key(t(h, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate DESC"])
    return present(out, ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"])


@register("drop_event_copies", """select user_id, event_type, strftime(hr, '%Y-%m-%d %H:%M:%S') as hr, value from (select user_id, event_type, date_trunc('hour', ts) as hr, value from events)
  qualify row_number() over (partition by user_id, event_type, hr order by value desc) = 1""")
def _(h):
    hourly = t(h, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hr"), "value")
    return present(dedupe.drop_copies(hourly, ["user_id", "event_type", "hr"]))


@register("duplicate_line_keys", "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by all having count(*) > 1")
def _(h):
    return dedupe.duplicate_keys(t(h, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("latest_line_per_order", """select o_orderkey, o_totalprice, l_partkey from orders left join (select l_orderkey, l_partkey from lineitem qualify row_number() over (partition by l_orderkey order by l_shipdate desc,
  l_partkey desc, l_suppkey desc, l_linenumber desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) = 1) on l_orderkey = o_orderkey""")
def _(h):
    last = dedupe.latest_child(t(h, "lineitem"), "l_orderkey", "l_shipdate").select("l_orderkey", "l_partkey")
    return t(h, "orders").join(last, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", "o_totalprice", "l_partkey")


@register("mrn_crosswalk", """select mrn, source_facility_id, min(canonical_patient_key) as canonical_patient_key, min(canonical_patient_key) <> max(canonical_patient_key) as is_conflict, count(*) as records
  from silver_patients group by all""")
def _(h):
    return dedupe.mrn_crosswalk(h._silver.base("patients"))


@register("payer_name_variants", """select patient_control_number, h.payer_id, coalesce(p.payer_name, h.payer_name) as payer_name, h.payer_name as payer_name_variant, p.payer_name is null as is_unmatched
  from bronze_claim_header h left join picked_payer p on p.payer_id = h.payer_id""")
def _(h):
    rows = h.bronze("claim_header").select("patient_control_number", "payer_id", "payer_name")
    return dedupe.canonical_names(rows, h._silver.base("payer"), "payer_id", "payer_name")


@register("deidentified_patients", 'select "Id", "Gender", "Race", sha256(mrn) as mrn, cast(null as varchar) as "Zip" from picked_patients')
def _(h):
    safe = deidentify(h._silver.base("patients"), hashed=["mrn"]).select("Id", "Gender", "Race", "mrn", "Zip")
    return role_view(safe, ["Id", "Gender", "Race", "mrn"])


# --- global order -----------------------------------------------------------------------------

@register("dense_customer_numbers", "select c_custkey, row_number() over (order by c_mktsegment, c_name) as customer_number from customer")
def _(h):
    return ordered.dense_number(t(h, "customer"), ["c_mktsegment", "c_name"], "customer_number").select("c_custkey", "customer_number")


@register("dense_rank_of_days", "select d as day, row_number() over (order by d) as day_number from (select distinct strftime(l_shipdate, '%Y-%m-%d') as d from lineitem)")
def _(h):
    days = t(h, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"))
    return ordered.number_distinct(days, "day", "day_number")


REVENUE = "cast(l_extendedprice as decimal(18,2))"


def _part_revenue(h):
    return t(h, "lineitem").groupBy("l_partkey").agg(F.sum(cents("l_extendedprice")).alias("revenue"))


@register("abc_classes_of_parts", f"""select l_partkey, cast(c as double) as cumulative_value, case when cast(c as double) / tot <= 0.8 then 'A' when cast(c as double) / tot <= 0.95 then 'B' else 'C' end as abc_class
  from (select *, sum(revenue) over (order by revenue desc, l_partkey desc rows unbounded preceding) as c, cast(sum(revenue) over () as double) as tot from (select l_partkey, sum({REVENUE}) as revenue from lineitem group by 1))""")
def _(h):
    return present(ordered.abc_classes(_part_revenue(h), "l_partkey", "revenue").select("l_partkey", "cumulative_value", "abc_class"))


@register("price_percentiles", """select l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.1), 9) as p10, round(quantile_cont(l_extendedprice, 0.5), 9) as p50, round(quantile_cont(l_extendedprice, 0.99), 9) as p99
  from lineitem group by all""")
def _(h):
    return present(exact_percentiles(t(h, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p99": 0.99}))


@register("balance_percentiles", "select count(*) as customers, round(quantile_cont(c_acctbal, 0.25), 9) as q1, round(quantile_cont(c_acctbal, 0.5), 9) as q2, round(quantile_cont(c_acctbal, 0.75), 9) as q3 from customer")
def _(h):
    return present(medians_with(t(h, "customer"), [], "c_acctbal", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, F.count(F.lit(1)).alias("customers")))


# --- neighbours, versions ---------------------------------------------------------------------

@register("next_and_previous_order", """select o_orderkey, lead(o_orderkey) over w as next_order, lag(o_orderkey) over w as previous_order, date_diff('day', o_orderdate, lead(o_orderdate) over w) as gap_days
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def _(h):
    month = F.date_trunc("month", "o_orderdate")
    orders = t(h, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    ahead = neighbours.neighbour(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"next_order": "o_orderkey", "next_date": "o_orderdate"}, month)
    both = neighbours.neighbour(ahead, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"previous_order": "o_orderkey"}, month, forward=False)
    return both.select("o_orderkey", "next_order", "previous_order", F.datediff("next_date", "o_orderdate").alias("gap_days"))


@register("order_sequence_numbers", """select o_orderkey, cast(row_number() over w as int) as seq, case when row_number() over w = 1 then 'admit' else 'transfer' end as event_type
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def _(h):
    out = neighbours.sequence_in_group(t(h, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.date_trunc("quarter", "o_orderdate"), "seq")
    return out.select("o_orderkey", "seq", F.when(F.col("seq") == 1, "admit").otherwise("transfer").alias("event_type"))


@register("event_sequence_numbers", """select event_id, cast(row_number() over (partition by k order by ts, event_id) as int) as seq
  from (select event_id, ts, case when event_id % 3 = 0 then 0 when event_id % 7 = 0 then null else user_id end as k from events)""")
def _(h):
    facts = t(h, "events").select("event_id", "ts", F.expr("CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 7 = 0 THEN NULL ELSE user_id END").alias("k"))
    out = neighbours.sequence_in_group(facts, ["k"], ["ts", "event_id"], F.date_trunc("day", "ts"), "seq")
    return out.select("event_id", "seq")


def _customer_versions(h, **options):
    snapshots = t(h, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyyMMdd").alias("_batch_id")).agg(F.max("o_orderpriority").alias("priority"))
    return scd.versions(snapshots, "o_custkey", attributes=["priority"], **options)


SNAPSHOTS = {"priority_snapshots": "select o_custkey, strftime(o_orderdate, '%Y%m%d') as b, max(o_orderpriority) as priority from orders group by all",
             "priority_changes": """select *, lead(b) over (partition by o_custkey order by b) as e from (select *, lag(priority) over (partition by o_custkey order by b) as was from priority_snapshots) where was is null or was <> priority"""}


@register("customer_versions", "select o_custkey, priority, b as valid_from, lead(b) over (partition by o_custkey order by b) as valid_to, lead(b) over (partition by o_custkey order by b) is null as is_current from priority_snapshots", **SNAPSHOTS)
def _(h):
    return _customer_versions(h).select("o_custkey", "priority", "valid_from", "valid_to", "is_current")


@register("customer_versions_compressed", "select o_custkey, priority, b as valid_from, e as valid_to, e is null as is_current from priority_changes", **SNAPSHOTS)
def _(h):
    return _customer_versions(h, compress=True).select("o_custkey", "priority", "valid_from", "valid_to", "is_current")


@register("customer_versions_closed", """select o_custkey, priority, b as valid_from, coalesce(n, case when b < (select max(b) from priority_snapshots) then b end) as valid_to,
  coalesce(n, case when b < (select max(b) from priority_snapshots) then b end) is null as is_current from (select *, lead(b) over (partition by o_custkey order by b) as n from priority_snapshots)""", **SNAPSHOTS)
def _(h):
    return _customer_versions(h, close_missing=True).select("o_custkey", "priority", "valid_from", "valid_to", "is_current")


@register("orders_as_of_version", """select o_orderkey, v.priority from (select o_orderkey, o_custkey, strftime(o_orderdate + interval 10 day, '%Y%m%d') as day_key from orders) o
  left join priority_changes v on v.o_custkey = o.o_custkey and b <= day_key and (e is null or day_key < e)""", **SNAPSHOTS)
def _(h):
    facts = t(h, "orders").select("o_orderkey", "o_custkey", F.date_format(F.date_add("o_orderdate", 10), "yyyyMMdd").alias("at"))
    return scd.as_of(facts, _customer_versions(h, compress=True), "o_custkey", "at", ["priority"]).select("o_orderkey", "priority")


@register("current_customer_version", "select o_custkey, priority from priority_changes where e is null", **SNAPSHOTS)
def _(h):
    return scd.current(_customer_versions(h, compress=True), "o_custkey").select("o_custkey", "priority")


@register("customer_history_applied", """select o_custkey, priority, b as valid_from, coalesce(e, case when seen < newest then seen end) as valid_to,
  coalesce(e, case when seen < newest then seen end) is null as is_current from (select *, lead(b) over (partition by o_custkey order by b) as e from
    (select *, lag(priority) over (partition by o_custkey order by b) as was, max(b) over (partition by o_custkey) as seen, max(b) over () as newest from
      (select o_custkey, strftime(o_orderdate, '%Y1231') as b, max(o_orderpriority) as priority from orders group by all)) where was is null or was <> priority)""")
def _(h):
    yearly = t(h, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy1231").alias("b")).agg(F.max("o_orderpriority").alias("priority"))
    history = History(Layers(h.spark, f"{shared_folder(h.spark)}/{uuid.uuid4().hex}"), "customer_history", "o_custkey", ("priority",), buckets=8)
    for (batch,) in yearly.select("b").distinct().orderBy("b").collect():  # the years
        history.apply(yearly.filter(F.col("b") == batch).drop("b"), batch)
    return history.read().select("o_custkey", "priority", "valid_from", "valid_to", "is_current")


# --- joins ------------------------------------------------------------------------------------

@register("skewed_event_lookup", """select e.event_id, e.k, u.n from (select event_id, case when event_id % 3 = 0 then 0 when event_id % 7 = 0 then null else user_id end as k from events) e
  left join (select user_id, count(*) as n from events group by 1) u on u.user_id = e.k""")
def _(h):
    facts = t(h, "events").select("event_id", F.expr("CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 7 = 0 THEN NULL ELSE user_id END").alias("k"))
    users = t(h, "events").groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return joins.hot_key_join(facts, users, "k", joins.hot_keys(facts, "k")).select("event_id", "k", "n")


@register("line_part_exists", "select l_orderkey, l_linenumber, l_partkey, l_partkey in (select p_partkey from part where p_size <= 40) as resolves from lineitem")
def _(h):
    gated = t(h, "part").filter("p_size <= 40")
    lines = t(h, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.with_exists(lines, gated, "l_partkey", "p_partkey", "resolves", joins.hot_keys(lines, "l_partkey"))


@register("customers_without_orders", "select c_custkey as key from customer where c_custkey not in (select o_custkey from orders)")
def _(h):
    return joins.orphans(t(h, "customer"), t(h, "orders"), "c_custkey", "o_custkey")


@register("customers_with_urgent_orders", "select c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')")
def _(h):
    urgent = t(h, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t(h, "customer").join(urgent, "c_custkey", "left_semi").select("c_custkey")


@register("part_prefix_class", """select p_partkey, case when p_type like 'STAN%' then 'standard' when p_type like 'SM%' then 'small' when p_type like 'S%' then 'other s' when p_type like 'M%' then 'medium' else 'none' end as class from part""")
def _(h):
    table = {"S": "other s", "SM": "small", "STAN": "standard", "M": "medium"}
    return joins.longest_prefix(t(h, "part"), "p_type", table, "class", "none").select("p_partkey", "class")


@register("orders_and_suppliers_by_nation", """select coalesce(a.k, b.k) as nation, coalesce(suppliers, 0) as suppliers, coalesce(rich, 0) as rich_customers from (select s_nationkey as k, count(*) as suppliers from supplier group by 1) a
  full join (select c_nationkey as k, count(*) as rich from customer where c_acctbal > 9000 group by 1) b on a.k = b.k""")
def _(h):
    left = t(h, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    right = t(h, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("rich_customers"))
    return aggregates.both_sides(left, right, ["nation"])


@register("encounter_minutes_by_day", f"""select strftime(d, '%Y-%m-%d') as day, count(*) as stays, round(sum(date_diff('second', greatest(s, d), least(e, d + interval 1 day))) / 60, 9) as minutes from
  (select s, e, unnest(generate_series(date_trunc('day', s), date_trunc('day', e), interval 1 day)) as d from (select {typed('clinical', '"Start"')} as s, {typed('clinical', '"Stop"')} as e from picked_encounters) where e > s)
  where least(e, d + interval 1 day) > greatest(s, d) group by 1""")
def _(h):
    daily = clip_to_days(h._silver.base("encounters").select("Start_ts", "Stop_ts"), "Start_ts", "Stop_ts")
    return present(daily.groupBy("day").agg(F.count(F.lit(1)).alias("stays"), (F.sum(
        F.unix_timestamp("clip_end") - F.unix_timestamp("clip_start")) / 60).alias("minutes")))


# --- aggregates -------------------------------------------------------------------------------

@register("revenue_by_region_with_total", """select coalesce(case when g = 1 then 'Total' end, r_name) as r_name, g = 1 as is_total, cast(rev as double) as revenue, orders from
  (select r_name, grouping(r_name) as g, sum(cast(o_totalprice as decimal(18,2))) as rev, count(*) as orders from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
   join region on r_regionkey = n_regionkey group by rollup (r_name))""")
def _(h):
    rows = (t(h, "orders").join(t(h, "customer"), F.col("c_custkey") == F.col("o_custkey"))
            .join(t(h, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t(h, "region"), F.col("r_regionkey") == F.col("n_regionkey")))
    return present(aggregates.with_total(rows, "r_name", [F.sum(cents("o_totalprice")).alias("revenue"), F.count(F.lit(1)).alias("orders")]))


@register("daily_value_pivot", """select user_id, strftime(d, '%Y-%m-%d') as day, last(value order by ts, value) filter (where event_type = 'click') as click, last(value order by ts, value) filter (where event_type = 'view') as view,
  last(value order by ts, value) filter (where event_type = 'error') as error from (select *, cast(ts as date) as d from events) group by user_id, d""")
def _(h):
    daily = t(h, "events").withColumn("day", F.to_date("ts"))
    return present(aggregates.latest_value_pivot(daily, ["user_id", "day"], "event_type", "value", "ts", {c: c for c in ["click", "view", "error"]}))


@register("event_trend", "select strftime(ts, '%Y-%m-%d') as day, count(*) as events, round(avg(value), 9) as mean_value, count(*) filter (where event_type = 'error') as errors from events group by 1")
def _(h):
    return present(aggregates.trend(t(h, "events").withColumn("day", F.to_date("ts")), "day", F.count(F.lit(1)).alias("events"),
                                    F.avg("value").alias("mean_value"), aggregates.count_where(F.col("event_type") == "error").alias("errors")))


@register("segment_rates", """select c_mktsegment, round(avg(cast(c_acctbal < 0 as int)), 9) as negative_rate, cast(sum(cast(c_acctbal as decimal(18,2))) filter (where c_acctbal > 0) as double) as positive_total,
  coalesce(round(count(*) filter (where c_acctbal < 0) / nullif(count(*) filter (where c_acctbal > 9990), 0), 9), 0) as odds, count(distinct c_nationkey) as nations from customer group by 1""")
def _(h):
    balance = F.col("c_acctbal")
    return present(t(h, "customer").groupBy("c_mktsegment").agg(
        aggregates.share_of(balance < 0).alias("negative_rate"), aggregates.sum_where(balance > 0, cents("c_acctbal")).alias("positive_total"),
        aggregates.ratio(aggregates.count_where(balance < 0), aggregates.count_where(balance > 9990), 0.0).alias("odds"),
        aggregates.distinct_with_blank(F.col("c_nationkey")).alias("nations")))


@register("top_parts_by_revenue", f"select l_partkey, cast(sum({REVENUE}) as double) as revenue from lineitem group by 1 order by sum({REVENUE}) desc, l_partkey limit 10")
def _(h):
    return present(aggregates.top(_part_revenue(h), [F.col("revenue").desc(), F.col("l_partkey")], 10))


@register("segment_revenue_spread", "select max(n) as highest, min(n) as lowest, max(n) - min(n) as spread, count(*) as groups from (select o_orderpriority, count(*) as n from orders group by 1)")
def _(h):
    return aggregates.spread(t(h, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), "n")


# --- scalar functions -------------------------------------------------------------------------

@register("calendar_of_orders", f"""select {ot.key('d')} as date_key, strftime(d, '%Y-%m-%d') as full_date, year(d) as year, month(d) as month, day(d) as day, dayofweek(d) + 1 as day_of_week, dayname(d) as day_name,
  monthname(d) as month_name, weekofyear(d) as iso_week, quarter(d) as quarter, dayofweek(d) in (0, 6) as is_weekend from (select distinct cast(o_orderdate as date) as d from orders)""")
def _(h):
    return present(with_calendar(t(h, "orders").select(F.to_date("o_orderdate").alias("full_date")).distinct()))


@register("timestamps_by_system", "select o_orderkey, strftime(o_orderdate + to_minutes(o_orderkey % 1440), '%Y-%m-%d %H:%M:%S') as at from orders")
def _(h):
    at = F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, "o_orderdate")
    formats = {"DAY_FIRST": "dd/MM/yyyy HH:mm", "MONTH_FIRST": "MM/dd/yyyy HH:mm", "T": "yyyy-MM-dd'T'HH:mm:ss"}
    names = F.array(*[F.lit(n) for n in [*formats, "ISO"]])
    raw = t(h, "orders").select("o_orderkey", F.element_at(names, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("system"), at.alias("t"))
    text = F.when(F.col("system") == "ISO", F.date_format("t", "yyyy-MM-dd HH:mm:ss"))
    for name, pattern in formats.items():
        text = text.when(F.col("system") == name, F.date_format("t", pattern))
    return present(raw.withColumn("text", text).select("o_orderkey", to_time_by_system("text", "system", formats).alias("at")))


@register("folded_dispositions", "select lower(trim(disposition)) as disposition, count(distinct disposition) as spellings, count(*) as stays from bronze_ed_stays group by 1")
def _(h):
    return h.bronze("ed_stays").groupBy(fold("disposition").alias("disposition")).agg(F.count_distinct("disposition").alias("spellings"), F.count(F.lit(1)).alias("stays"))


@register("numbers_with_units", "select heartrate, count(*) as stays, cast(regexp_extract(heartrate, '(-?[0-9]+)', 1) as double) as repaired from bronze_ed_stays where heartrate like '% mg' group by all")
def _(h):
    return h.bronze("ed_stays").filter("heartrate LIKE '% mg'").groupBy("heartrate", number_with_unit("heartrate").alias("repaired")).agg(F.count(F.lit(1)).alias("stays"))


@register("other_diagnoses_exploded", "select code, count(*) as claims from (select unnest(string_split(other_diagnoses, '|')) as code from bronze_claim_header) group by 1")
def _(h):
    codes = h.bronze("claim_header").select(F.explode(F.split("other_diagnoses", r"\|")).alias("code"))
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("claims"))


@register("event_properties", "select event_type, sum(cast(json_extract_string(props, '$.k') as bigint)) as k_total, max(cast(json_extract_string(props, '$.k') as bigint)) as k_max from events group by 1")
def _(h):
    parsed = t(h, "events").withColumn("p", F.from_json("props", "k bigint"))
    return parsed.groupBy("event_type").agg(F.sum("p.k").alias("k_total"), F.max("p.k").alias("k_max"))


@register("name_patterns", "select p_partkey, p_name like '%widget%' as is_widget, regexp_matches(lower(p_name), 'ring|bolt') as is_hardware from part")
def _(h):
    return t(h, "part").select("p_partkey", F.col("p_name").like("%widget%").alias("is_widget"), F.col("p_name").rlike("(?i)ring|bolt").alias("is_hardware"))


@register("risk_sentences", """select p_partkey, case when r >= 0.9 then p_name || ' is at ' || cast(cast(round(r * 100) as int) as varchar) || '% occupancy — approaching capacity'
  when r >= 0.8 then p_name || ' is at ' || cast(cast(round(r * 100) as int) as varchar) || '% occupancy — monitor closely' end as sentence from (select *, p_size / 50 as r from part)""")
def _(h):
    return t(h, "part").withColumn("r", F.col("p_size") / 50).select("p_partkey", risk_sentence("p_name", "r").alias("sentence"))


@register("late_issue_added", """select "Id", concat_ws('; ', nullif(_dq_issues, ''), case when "Gender" = 'M' and is_high_risk_bool then 'needs review' end) as _dq_issues,
  _dq_passed and not coalesce("Gender" = 'M' and is_high_risk_bool, false) as _dq_passed from silver_patients""")
def _(h):
    out = add_issue(h.silver("patients"), (F.col("Gender") == "M") & F.col("is_high_risk_bool"), "needs review")
    return out.select("Id", "_dq_issues", "_dq_passed")


@register("union_of_party_keys", "select 'customer' as kind, c_nationkey as nation, count(*) as parties from customer group by 2 union all select 'supplier', s_nationkey, count(*) from supplier group by 2")
def _(h):
    customers = t(h, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    suppliers = t(h, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"))
    both = customers.unionByName(suppliers, allowMissingColumns=True)
    return both.groupBy("kind", "nation").agg(F.count(F.lit(1)).alias("parties"))


# --- event stream (batch twin) ----------------------------------------------------------------

def envelopes(h: Hospital) -> DataFrame:
    """The derived feed in wire form: an envelope with a JSON payload."""
    feed = h.bronze.events().withColumn("event_time", F.col("event_time").cast("timestamp"))
    payload = F.to_json(F.struct("encounter_id", "unit_id", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("charttime"), "loinc_code", "value_num", "is_artifact",
                                 F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("entertime"),
                                 F.date_format(F.timestamp_add("MINUTE", F.col("lag_seconds"), "event_time"), "yyyy-MM-dd'T'HH:mm:ss").alias("verifiedtime"),
                                 F.col("value_num").cast("string").alias("dose_val_rx"), (F.col("loinc_code") == "2708-6").alias("is_controlled")))
    return feed.select("event_id", "event_type", "event_time", F.timestamp_add("SECOND", F.col("lag_seconds"), "event_time").alias("ingest_time"),
                       "source_system", "facility_id", "schema_version", payload.alias("payload"))


def readings(h: Hospital) -> DataFrame:
    """Parsed, deduplicated monitor readings without artefacts."""
    parsed = ev.parse_events(ev.route(envelopes(h), ev.VITALS), ev.VITALS_PAYLOAD)
    return vitals.drop_artifacts(ev.dedupe_events(ev.with_event_watermark(parsed)))


STREAM = {"stream_events": "select distinct on (event_id) *, event_time + to_seconds(lag_seconds) as ingest_time from events_feed",
          "stream_readings": "select * from stream_events where event_type = 'vitals.reading' and value_num is not null and not is_artifact"}


@register("stream_routing", "select event_type, count(*) as events from events_feed group by 1")
def _(h):
    both = envelopes(h)
    routed = ev.route(both, ev.VITALS).unionByName(ev.route(both, ev.PRESCRIPTION))
    return routed.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@register("stream_unique_readings", "select event_id, encounter_id, loinc_code, value_num from stream_readings", **STREAM)
def _(h):
    return readings(h).select("event_id", "encounter_id", "loinc_code", "value_num")


@register("stream_lateness", "select lag_seconds > 60 as is_late, count(*) as events, max(lag_seconds) as worst_lag from events_feed group by 1", **STREAM)
def _(h):
    late = ev.classify_late(envelopes(h), 60)
    return late.groupBy("is_late").agg(F.count(F.lit(1)).alias("events"), F.max("arrival_lag_seconds").alias("worst_lag"))


@register("stream_window_median", """select strftime(time_bucket(interval '5 minutes', event_time), '%Y-%m-%d %H:%M:%S') as window_start, encounter_id, loinc_code, round(quantile_cont(value_num, 0.5), 9) as value_median,
  count(*) as readings from stream_readings group by all""", **STREAM)
def _(h):
    return present(vitals.window_median(readings(h)))


_WIDE = ", ".join(f"last(value_num order by ingest_time, value_num) filter (where loinc_code = '{c}') as {n}" for c, n in {
    "8867-4": "heart_rate", "8480-6": "systolic_bp", "8462-4": "diastolic_bp", "9279-1": "respiratory_rate", "8310-5": "temperature", "2708-6": "spo2"}.items())
WIDE = {**STREAM, "wide_vitals": f"select time_bucket(interval '6 hours', event_time) as charttime, encounter_id, {_WIDE} from stream_readings group by all"}


@register("stream_wide_vitals", "select strftime(charttime, '%Y-%m-%d %H:%M:%S') as charttime, encounter_id, heart_rate, systolic_bp, diastolic_bp, respiratory_rate, temperature, spo2 from wide_vitals", **WIDE)
def _(h):
    return present(vitals.pivot_vitals(readings(h), "6 hours"))


@register("stream_news2", """select strftime(charttime, '%Y-%m-%d %H:%M:%S') as charttime, encounter_id, n as parameters, s as news2_score,
  case when s >= 7 then 'emergency' when s >= 5 then 'urgent' when w = 3 then 'review' else 'routine' end as response from
  (select *, coalesce(a,0)+coalesce(b,0)+coalesce(c,0)+coalesce(d,0)+coalesce(e,0) as s, greatest(coalesce(a,0),coalesce(b,0),coalesce(c,0),coalesce(d,0),coalesce(e,0)) as w,
     cast(a is not null as int)+cast(b is not null as int)+cast(c is not null as int)+cast(d is not null as int)+cast(e is not null as int) as n from
   (select *, case when respiratory_rate is null then null when respiratory_rate <= 8 then 3 when respiratory_rate <= 11 then 1 when respiratory_rate <= 20 then 0 when respiratory_rate <= 24 then 2 else 3 end as a,
     case when spo2 is null then null when spo2 <= 91 then 3 when spo2 <= 93 then 2 when spo2 <= 95 then 1 else 0 end as b,
     case when systolic_bp is null then null when systolic_bp <= 90 then 3 when systolic_bp <= 100 then 2 when systolic_bp <= 110 then 1 when systolic_bp < 220 then 0 else 3 end as c,
     case when heart_rate is null then null when heart_rate <= 40 then 3 when heart_rate <= 50 then 1 when heart_rate <= 90 then 0 when heart_rate <= 110 then 1 when heart_rate <= 130 then 2 else 3 end as d,
     case when temperature is null then null when temperature <= 35 then 3 when temperature <= 36 then 1 when temperature <= 38 then 0 when temperature <= 39 then 1 else 2 end as e from wide_vitals))""", **WIDE)
def _(h):
    return present(vitals.news2(vitals.pivot_vitals(readings(h), "6 hours")).select("charttime", "encounter_id", "parameters", "news2_score", "response"))


ALARM = """(loinc_code = '8867-4' and (value_num <= 40 or value_num >= 131)) or (loinc_code = '8480-6' and (value_num <= 90 or value_num >= 220)) or (loinc_code = '9279-1' and (value_num <= 8 or value_num >= 25))
  or (loinc_code = '8310-5' and value_num <= 35) or (loinc_code = '2708-6' and value_num <= 91)"""


@register("stream_alert_rate", f"""select strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') as window_start, unit_id, count(*) as readings, count(*) filter (where {ALARM}) as alarms,
  round(count(*) filter (where {ALARM}) / count(*), 9) as alarm_rate from stream_readings group by all""", **STREAM)
def _(h):
    return present(vitals.alert_rate(readings(h)))


@register("stream_signal_gaps", """select encounter_id, strftime(c, '%Y-%m-%d %H:%M:%S') as charttime, date_diff('second', c, n) as gap_seconds from
  (select encounter_id, c, lead(c) over (partition by encounter_id order by c) as n from (select distinct encounter_id, date_trunc('second', event_time) as c from stream_readings)) where date_diff('second', c, n) > 7200""", **STREAM)
def _(h):
    return present(vitals.signal_gaps(readings(h), 7200), ["encounter_id", "charttime", "gap_seconds"])


@register("silence_alarms", """select encounter_id, strftime(c, '%Y-%m-%d %H:%M:%S') as silent_since, strftime(c + interval 2 hour, '%Y-%m-%d %H:%M:%S') as alarm_at from
  (select encounter_id, c, ends, lead(c) over (partition by encounter_id order by c, ends) as n from
    (select distinct user_id::varchar as encounter_id, date_trunc('second', ts) as c, event_type = 'error' as ends from events where user_id is not null and ts is not null))
  where not ends and coalesce(n, timestamp '2030-01-01') > c + interval 2 hour""")
def _(h):
    watched = t(h, "events").select(F.col("user_id").alias("encounter_id"), F.date_trunc("second", "ts").alias("event_time"),
                                    (F.col("event_type") == "error").alias("ends"))
    return present(silences(watched, "2030-01-01", 7200))


@register("stream_in_flight", """select case when e."Id" is null then 'in_flight' else 'closed' end as encounter_state, count(*) as events from stream_readings r
  left join (select "Id" from silver_encounters where _dq_passed) e on e."Id" = r.encounter_id group by 1""", **STREAM)
def _(h):
    known = gate(h.silver("encounters")).select(F.col("Id").alias("encounter_id"), "Start_ts")
    return ev.enrich_static(readings(h), known, ["Start_ts"]).groupBy("encounter_state").agg(F.count(F.lit(1)).alias("events"))


@register("stream_prescriptions", """select facility_id, count(*) as prescriptions, count(*) filter (where loinc_code = '2708-6') as controlled, round(avg(lag_seconds), 9) as avg_verify_minutes
  from stream_events where event_type = 'prescription.issued' group by 1""", **STREAM)
def _(h):
    issued = ev.dedupe_events(ev.parse_events(ev.route(envelopes(h), ev.PRESCRIPTION), ev.PRESCRIPTION_PAYLOAD))
    return present(prescriptions.controlled_counts(prescriptions.type_prescriptions(issued)))

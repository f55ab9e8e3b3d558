"""Registered queries over the driver test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame that reads the
given tables; ``__spark_entry__`` exposes them by name.  The incident reports
run on the analog star defined in :mod:`.teststar`.  Most queries are lazy;
those that number keys, stage a star or write a mart run jobs while they are
built, because their tables have to be fixed before they are read.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BAND_ORDER, DAY_NAMES
from ..functions.calendar import band_order, parse_date, time_key
from ..functions.numbers import coerce_int, format_int
from ..functions.text import clean_text
from ..operators import quality as Q
from ..operators.enrich import left_enrich
from ..operators.joins import through_dimensions
from ..operators.keys import Members, lookup_members, number_members, with_digests
from ..operators.measures import (distinct_values, drilldown, kpi, moving_average,
                                  period_change, rank_groups, share_of_total, sum_measures,
                                  top_k, top_n_per_group)
from ..operators.reshape import pivot_matrix, series_long, unpivot_totals
from ..sources.series import literal_rows
from ..staging import scratch_dir, stage
from . import teststar as ts
from .calendar import (date_bounds, first_month, insert_if_absent, time_dim, year_calendar,
                       year_calendar_covering)
from .marts import report_mart, sum_mart


# ---------------------------------------------------------------- dimensions

def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of every year the events touch (bounds from the data)."""
    return year_calendar_covering(ts.event_dates(spark, sf_dir), "d")


def q_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes of the day plus the unknown member, with the events per
    minute (left join from the dimension, so all 1,441 members stay)."""
    ev = ts.table(spark, sf_dir, "events")
    per_minute = ev.groupBy(time_key(F.coalesce(F.hour("ts"), F.lit(0)),
                                     F.coalesce(F.minute("ts"), F.lit(0))).alias("time_key")) \
        .agg(F.count(F.lit(1)).alias("event_count"))
    joined = time_dim(spark).join(per_minute, "time_key", "left")
    return joined.withColumn("event_count", F.coalesce("event_count", F.lit(0)).cast("bigint"))


def q_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first month of events loaded first, then the calendar of the
    event years inserted if absent.  The events are scanned once, for the one
    staged row of bounds that both calendars come from."""
    bounds = stage(date_bounds(ts.event_dates(spark, sf_dir), "d"), "bounds")
    return insert_if_absent(first_month(bounds), year_calendar(bounds), ["date_key"])


# ---------------------------------------------------------------- Q1

def _events_by_nation(spark, sf_dir, event_types=None):
    """Event measures per customer, aggregating before the customer join."""
    where = F.col("event_type").isin(*event_types) if event_types else None
    fact = ts.events_fact(spark, sf_dir, extra=["user_id"], where=where)
    per_user = ts.pre_aggregate_by_key(fact, "user_id", ts.EVENT_MEASURES)
    cust = ts.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return per_user.join(cust, per_user.user_id == cust.c_custkey)


def q_entity_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: nations with most events, error/purchase ratios, top 10 by rank."""
    per_cust = _events_by_nation(spark, sf_dir)
    per_nat = per_cust.groupBy("c_nationkey").agg(
        *[F.sum(c).alias(c) for c in ts.EVENT_MEASURES.values()])
    names = ts.nation_region(spark, sf_dir)
    named = per_nat.join(names, per_nat.c_nationkey == names.n_nationkey)
    agg = sum_measures(named, ["n_name"], ts.EVENT_MEASURES)
    ranked = rank_groups(agg, "n_name", "total_events", 10, ratios={
        "errors_per_event": ("total_errors", "total_events", 4),
        "purchases_per_event": ("total_purchases", "total_events", 4)})
    return ranked.select("ranking", "n_name", "total_events", "total_errors", "total_purchases",
                         "errors_per_event", "purchases_per_event").orderBy("ranking", "n_name")


# ---------------------------------------------------------------- Q2, Q3, U5

def q_month_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: orders by month number with previous month, change and %."""
    ddim = year_calendar_covering(ts.order_dates(spark, sf_dir), "d")
    agg = through_dimensions(ts.orders_fact(spark, sf_dir),
                             [(ddim, "date_key", ["mes_numero", "mes_nombre"])], ts.ORDER_MEASURES)
    return period_change(agg, "mes_numero", "total_orders", "prev_total_orders",
                         "change_orders", "pct_change_orders", 2).orderBy("mes_numero")


def _daily_moving_average(spark, sf_dir):
    ddim = year_calendar_covering(ts.order_dates(spark, sf_dir), "d")
    agg = through_dimensions(ts.orders_fact(spark, sf_dir), [(ddim, "date_key", ["full_date"])],
                             {"total_orders": "num_orders"})
    return moving_average(agg, "full_date", "total_orders", "moving_avg_7", 7, 2)


def q_moving_average_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: orders per day with a 7-row moving average (days present only)."""
    return _daily_moving_average(spark, sf_dir).orderBy("full_date")


def q_series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series and its moving average as (day, variable, value)."""
    return series_long(_daily_moving_average(spark, sf_dir), ["full_date"],
                       ["total_orders", "moving_avg_7"])


# ---------------------------------------------------------------- Q4, Q4b

def _weekday_band_agg(spark, sf_dir):
    ddim = year_calendar_covering(ts.event_dates(spark, sf_dir), "d")
    agg = through_dimensions(ts.events_fact(spark, sf_dir), [
        (ddim, "date_key", ["dia_semana_numero", "dia_semana_nombre"]),
        (time_dim(spark), "time_key", ["banda_horaria"])], ts.EVENT_MEASURES)
    return agg.withColumn("banda_orden", band_order("banda_horaria"))


def q_weekday_band_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: events by ISO weekday x time band."""
    return _weekday_band_agg(spark, sf_dir).orderBy("dia_semana_numero", "banda_orden")


def q_weekday_band_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile as a 7 x 5 matrix of event counts."""
    prof = _weekday_band_agg(spark, sf_dir)
    return pivot_matrix(spark, prof, "dia_semana_nombre", "banda_horaria", "total_events",
                        DAY_NAMES, BAND_ORDER, row_order="dia_semana_numero")


# ---------------------------------------------------------------- Q5, Q5b

def _orders_by_nation(spark, sf_dir):
    fact = ts.orders_fact(spark, sf_dir, extra=["o_custkey"])
    per_cust = ts.pre_aggregate_by_key(fact, "o_custkey", ts.ORDER_MEASURES)
    cust = ts.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_nat = (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
               .groupBy("c_nationkey").agg(*[F.sum(c).alias(c) for c in ts.ORDER_MEASURES.values()]))
    names = ts.nation_region(spark, sf_dir)
    named = per_nat.join(names, per_nat.c_nationkey == names.n_nationkey)
    return sum_measures(named, ["r_name", "n_name"], ts.ORDER_MEASURES)


def q_top_members_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: top 3 nations by orders within each region (ties by name)."""
    agg = _orders_by_nation(spark, sf_dir)
    return (top_n_per_group(agg, ["r_name"], "n_name", "total_orders", 3, "rank_in_region")
            .orderBy("r_name", "rank_in_region"))


DRILLDOWN_REGION = "AMERICA"


def q_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-3 list of one region, ascending for presentation."""
    return drilldown(q_top_members_per_group(spark, sf_dir), "r_name", DRILLDOWN_REGION,
                     "total_orders")


def q_group_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted list of regions offered for drill-down.

    Every region with an order has a top-3 list, so the regions are those with
    a customer who ordered; no order is summed or ranked.
    """
    buyers = ts.table(spark, sf_dir, "orders").select("o_custkey").distinct()
    cust = ts.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = cust.join(buyers, cust.c_custkey == buyers.o_custkey, "left_semi").select("c_nationkey").distinct()
    names = ts.nation_region(spark, sf_dir)
    return distinct_values(names.join(nations, names.n_nationkey == nations.c_nationkey, "left_semi"), "r_name")


# ---------------------------------------------------------------- Q6, Q7

def q_share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: share of events per event type (percent, 2 decimals)."""
    fact = ts.events_fact(spark, sf_dir, extra=["event_type"])
    agg = sum_measures(fact, ["event_type"], ts.EVENT_MEASURES)
    return (share_of_total(agg, "total_events", "pct_events", 2)
            .orderBy(F.col("total_events").desc_nulls_first(), "event_type"))


def q_measure_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: totals of four lineitem counters, one row each, ranked."""
    li = ts.table(spark, sf_dir, "lineitem")
    cols = [
        ("quantity", F.col("l_quantity").cast("bigint")),
        ("line_number", F.col("l_linenumber").cast("bigint")),
        ("discount_pct", F.round(F.col("l_discount") * 100).cast("bigint")),
        ("tax_pct", F.round(F.col("l_tax") * 100).cast("bigint")),
    ]
    return unpivot_totals(li, cols, "measure", "total", "ranking") \
        .orderBy(F.col("total").desc_nulls_first(), "measure")


# ---------------------------------------------------------------- KPIs, Q8

def q_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: fact rows and event total, plus the display string."""
    fact = ts.events_fact(spark, sf_dir)
    out = kpi(fact, {"total_events": "num_events"}, count_name="fact_rows")
    return out.withColumn("total_events_text", format_int("total_events"))


def q_kpi_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 (own definition): KPI with the two severity-like totals."""
    fact = ts.events_fact(spark, sf_dir)
    out = kpi(fact, ts.EVENT_MEASURES, count_name="fact_rows")
    return out.select("*", *[format_int(c).alias(f"{c}_text") for c in ts.EVENT_MEASURES])


def q_profile_of_severe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 (own definition): error and purchase events by customer segment.

    The event-type predicate is written on the raw column, so it reaches the
    Parquet scan as a pushed ``IN`` filter (the partial-index predicate P12).
    """
    per_cust = _events_by_nation(spark, sf_dir, event_types=["error", "purchase"])
    return sum_measures(per_cust, ["c_mktsegment"], ts.EVENT_MEASURES).orderBy("c_mktsegment")


# ---------------------------------------------------------------- dirty-data rules

def _dirty_events(spark, sf_dir):
    return ts.table(spark, sf_dir, "events")


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing tokens, blanks, TAB and NBSP edges cleaned to labels."""
    ev = _dirty_events(spark, sf_dir)
    k = F.col("event_id") % 11
    et = F.col("event_type")
    raw = (F.when(k == 0, F.lit(None).cast("string"))
           .when(k == 1, F.lit(""))
           .when(k == 2, F.lit("   "))
           .when(k == 3, F.lit("NA"))
           .when(k == 4, F.concat(F.lit("  "), et, F.lit(" ")))
           .when(k == 5, F.concat(F.lit("\t"), et))
           .when(k == 6, F.concat(et, F.lit("\u00a0")))
           .when(k == 7, F.lit("null"))
           .when(k == 8, F.concat(F.lit(" NA "), et))
           .otherwise(et))
    return ev.select("event_id", clean_text(raw).alias("clean_value"))


def q_coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text -> number -> 0 when missing -> truncated integer."""
    ev = _dirty_events(spark, sf_dir)
    k = F.col("event_id") % 17
    v = F.col("value").cast("string")
    raw = (F.when(k == 0, F.lit(None).cast("string"))
           .when(k == 1, F.lit("x"))
           .when(k == 2, F.concat(F.lit(" "), v, F.lit(" ")))
           .when(k == 3, F.concat(F.lit("-"), v))
           .when(k == 4, F.lit("3d"))
           .when(k == 5, F.lit("0x1p3"))
           .when(k == 6, F.lit("9007199254740993"))
           .when(k == 7, F.lit("3f"))
           .when(k == 8, F.lit("-.5e1"))
           .otherwise(v))
    return ev.select("event_id", coerce_int(raw).alias("value_int"))


def q_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates from parts; impossible dates (Feb 30, month 0, 2023-02-29) are NULL."""
    ev = _dirty_events(spark, sf_dir)
    eid = F.col("event_id")
    y = F.when(eid % 13 == 0, F.lit(2023)).otherwise(F.year("ts"))
    m = (F.when(eid % 19 == 0, F.lit(0))
         .when(eid % 5 == 0, F.lit(2))
         .otherwise(F.month("ts")))
    d = F.when(eid % 17 == 0, F.lit(30)).when(eid % 3 == 0, F.lit(29)).otherwise(F.dayofmonth("ts"))
    out = ev.select("event_id", y.alias("y"), m.alias("m"), d.alias("d"))
    return out.withColumn("parsed_date", parse_date("y", "m", "d")) \
        .withColumn("is_valid", F.col("parsed_date").isNotNull())


def q_time_key_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing parts -> 0 before the range test, out of range -> -1."""
    ev = _dirty_events(spark, sf_dir)
    eid = F.col("event_id")
    h_raw = (F.when(eid % 9 == 0, F.lit(None).cast("string"))
             .when(eid % 9 == 1, F.lit("99"))
             .otherwise(F.hour("ts").cast("string")))
    m_raw = (F.when(eid % 8 == 0, F.lit(None).cast("string"))
             .when(eid % 8 == 1, F.lit("99"))
             .when(eid % 8 == 2, F.lit("60"))
             .otherwise(F.minute("ts").cast("string")))
    base = ev.select("event_id", coerce_int(h_raw).alias("hora"), coerce_int(m_raw).alias("minuto"))
    keyed = base.withColumn("time_key", time_key("hora", "minuto"))
    tdim = time_dim(spark).select(F.col("time_key").cast("bigint").alias("time_key"), "banda_horaria")
    return keyed.join(tdim, "time_key", "left")


def q_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level code enrichment keeping every row.

    Customer rows carry a region code and a (region, nation) code pair like
    an incident row carries entity and municipality codes.  Some codes are
    blanked or made unknown; the region catalog has a NULL-code row, which a
    NULL code matches.
    """
    cust = ts.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = ts.table(spark, sf_dir, "nation")
    raw = cust.join(nation.select("n_nationkey", "n_regionkey"),
                    cust.c_nationkey == nation.n_nationkey, "left")
    k = F.col("c_custkey") % 10
    raw = raw.select(
        "c_custkey",
        F.when(k == 0, F.lit(None).cast("int")).otherwise(F.col("n_regionkey")).alias("region_code"),
        F.when(k == 1, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")).alias("nation_code"))
    regions = ts.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("region_code"), F.col("r_name").alias("region_name"))
    regions = regions.unionByName(literal_rows(
        spark, [(None, "REGION NULA")], "region_code int, region_name string"))
    nations = nation.select(F.col("n_regionkey").alias("region_code"),
                            F.col("n_nationkey").alias("nation_code"),
                            F.col("n_name").alias("nation_name"))
    out = left_enrich(raw, regions, ["region_code"], ["region_name"], name="region catalog")
    out = left_enrich(out, nations, ["region_code", "nation_code"], ["nation_name"],
                      name="nation catalog")
    return out.select("c_custkey", "region_code", "nation_code",
                      clean_text("region_name").alias("region_name"),
                      clean_text("nation_name").alias("nation_name"))


# ---------------------------------------------------------------- derived dims, keyed fact

LOCATION_COLS = ["n_nationkey", "r_name", "n_name", "c_mktsegment"]
DESCRIPTOR_COLS = ["o_orderstatus", "o_orderpriority"]
PROFILE_COLS = ["c_mktsegment", "o_orderpriority"]


def _orders_base(spark, sf_dir):
    """Orders with the natural attributes of all three derived dimensions.

    Left joins: an order whose customer is unknown stays, without them.
    """
    od = ts.table(spark, sf_dir, "orders")
    od = od.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                   ts.date_key(F.to_date("o_orderdate")).alias("date_key"),
                   F.lit(1).alias("num_orders"),
                   (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("is_urgent"),
                   (F.col("o_orderstatus") == "F").cast("int").alias("is_finished"))
    cust = ts.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    names = ts.nation_region(spark, sf_dir)
    cust = cust.join(names, cust.c_nationkey == names.n_nationkey, "left")
    return od.join(cust, od.o_custkey == cust.c_custkey, "left")


DERIVED = {"location": (LOCATION_COLS, "location_key"),
           "descriptor": (DESCRIPTOR_COLS, "descriptor_key"),
           "profile": (PROFILE_COLS, "profile_key")}


def _derived_dim(spark, sf_dir, name):
    """A member needs its whole natural key."""
    return number_members(_orders_base(spark, sf_dir), {name: DERIVED[name]}, whole=True)[name].frame


def q_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct nation x segment locations with dense keys in sort order."""
    return _derived_dim(spark, sf_dir, "location")


def q_dim_descriptor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junk dimension of order status x priority."""
    return _derived_dim(spark, sf_dir, "descriptor")


def q_dim_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyer profile (segment x priority)."""
    return _derived_dim(spark, sf_dir, "profile")


FACT_COLUMNS = ["source_row_id", "date_key", "location_key", "descriptor_key", "profile_key",
                "num_orders", "is_urgent", "is_finished"]


def star_of(base: DataFrame, label: str, names: tuple[str, ...] = tuple(DERIVED)) -> tuple[DataFrame, dict[str, Members]]:
    """Keyed fact and derived dimensions (``names`` of them) of a base.

    The base is written once with a digest of each natural key.  The dimensions
    come from one grouping-sets aggregate over it, and the fact looks its keys
    up by the digests (J5-J7).
    """
    specs = {n: DERIVED[n] for n in names}
    base = stage(with_digests(base, {n: cols for n, (cols, _) in specs.items()}), label)
    dims = number_members(base, specs, whole=True)
    fact = lookup_members(base, dims).withColumnRenamed("o_orderkey", "source_row_id")
    return fact.select(*[c for c in FACT_COLUMNS if c in fact.columns]), dims


def staged_star(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = tuple(DERIVED)) -> tuple[DataFrame, dict[str, Members]]:
    """D5 on the orders: they are scanned and joined once, for the staged base."""
    return star_of(_orders_base(spark, sf_dir), "orders-base", names)


def q_fact_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_star(spark, sf_dir)[0]


def q_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and measure sums of the orders fact (no key is needed)."""
    return kpi(ts.orders_fact(spark, sf_dir), ts.ORDER_MEASURES, count_name="fact_rows")


def q_null_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count of every key of the keyed fact.

    Every 1,009th order counts as one of an unknown customer and every 503rd
    lacks its status, so the report is not all zeros.
    """
    rid = F.col("o_orderkey")
    gone = {c: rid % 1009 == 4 for c in LOCATION_COLS} | {"o_orderstatus": rid % 503 == 2}
    base = _orders_base(spark, sf_dir)
    dirty = base.select(*[F.when(~gone[c], F.col(c)).alias(c) if c in gone else F.col(c) for c in base.columns])
    fact, _ = star_of(dirty, "orders-dirty")
    return Q.null_counts(fact, ["date_key", "location_key", "descriptor_key", "profile_key"])


def q_top_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nations with most orders, through the location dimension."""
    fact, dims = staged_star(spark, sf_dir, ("location",))
    agg = through_dimensions(fact, [(dims["location"].frame, "location_key", ["n_name"])], ts.ORDER_MEASURES)
    return top_k(agg, "total_orders", 10, label="n_name")


# Text limits of the analog dimensions (V12), as VARCHAR lengths.
LENGTHS = {"r_name": 25, "n_name": 25, "c_mktsegment": 10, "o_orderstatus": 1, "o_orderpriority": 15}


def q_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the analog star as a violation count.

    Violations are injected into the staged fact (a foreign key outside the
    calendar, a negative count, a repeated id, a wrong constant) so the report
    is not all zeros; orders of unknown customers and dates show by themselves.
    The fact's row rules are measured as it is written, its primary key by
    bitmaps, its foreign keys on their distinct values.
    """
    fact, dims = staged_star(spark, sf_dir)
    rid = F.col("source_row_id")
    dirty = fact.select(
        F.when(rid % 1000 == 7, F.lit(1)).otherwise(rid).alias("source_row_id"),
        F.when(rid % 997 == 3, F.lit(19000101)).otherwise(F.col("date_key")).alias("date_key"),
        "location_key", "descriptor_key", "profile_key",
        F.when(rid % 991 == 5, F.lit(2)).otherwise(F.col("num_orders")).alias("num_orders"),
        F.when(rid % 983 == 11, F.lit(-1)).otherwise(F.col("is_urgent")).alias("is_urgent"),
        F.when(rid % 977 == 13, F.lit(-1)).otherwise(F.col("is_finished")).alias("is_finished"))
    seen = Q.WriteMetrics(dirty, "fact", {
        **Q.not_null_rules(["date_key", "location_key", "descriptor_key", "profile_key"]),
        "const:num_orders": F.col("num_orders") != 1,
        "nonneg:is_urgent": F.col("is_urgent") < 0,
        "nonneg:is_finished": F.col("is_finished") < 0,
        "smallint:counts": F.greatest("is_urgent", "is_finished") > 32767})
    dirty = stage(seen.watched, "fact-dirty")
    ddim = stage(year_calendar_covering(ts.order_dates(spark, sf_dir), "d"), "calendar")
    tdim = time_dim(spark)
    loc, desc, prof = (stage(dims[n].frame, f"dim-{n}") for n in ("location", "descriptor", "profile"))

    def attributes(cols):
        return {**Q.not_null_rules(cols),
                **{f"length:{c}": F.length(c) > LENGTHS[c] for c in cols if c in LENGTHS}}

    parts = [
        Q.table_rules(ddim, "dim_date", {
            **Q.not_null_rules(["date_key", "full_date", "mes_nombre", "dia_semana_nombre"]),
            "range:mes_numero": ~F.col("mes_numero").between(1, 12),
            "range:dia_mes": ~F.col("dia_mes").between(1, 31),
            "range:trimestre": ~F.col("trimestre").between(1, 4),
            "range:dia_semana_numero": ~F.col("dia_semana_numero").between(1, 7),
        }, {"pk": ["date_key"], "unique:full_date": ["full_date"]}),
        Q.table_rules(tdim, "dim_time", {
            **Q.not_null_rules(["time_key", "hora", "minuto", "hora_texto", "banda_horaria"]),
            "range:hora": ~F.col("hora").between(-1, 23),
            "range:minuto": ~F.col("minuto").between(-1, 59),
            "domain:banda_horaria": ~F.col("banda_horaria").isin(*BAND_ORDER),
        }, {"pk": ["time_key"], "unique:hora_texto": ["hora_texto"]}),
        Q.table_rules(loc, "dim_location", attributes(["location_key", *LOCATION_COLS]),
                      {"pk": ["location_key"], "unique:natural": LOCATION_COLS}),
        Q.dependency_rule(loc, "dim_location", "fd:nation_segment->names",
                          ["n_nationkey", "c_mktsegment"], ["r_name", "n_name"]),
        Q.table_rules(desc, "dim_descriptor", attributes(["descriptor_key", *DESCRIPTOR_COLS]),
                      {"pk": ["descriptor_key"], "unique:natural": DESCRIPTOR_COLS}),
        Q.table_rules(prof, "dim_profile", attributes(["profile_key", *PROFILE_COLS]),
                      {"pk": ["profile_key"], "unique:natural": PROFILE_COLS}),
        Q.unique_rule(ts.table(spark, sf_dir, "nation"), "nation", "many_to_one:n_nationkey", ["n_nationkey"]),
        Q.unique_rule(ts.table(spark, sf_dir, "region"), "region", "many_to_one:r_regionkey", ["r_regionkey"]),
        Q.dense_unique_rule(dirty, "fact", "pk", "source_row_id"),
        seen.report(spark),
        Q.foreign_key_rules(dirty, "fact", [
            ("date_key", ddim, "date_key", "fk:date_key"),
            ("location_key", loc, "location_key", "fk:location_key"),
            ("descriptor_key", desc, "descriptor_key", "fk:descriptor_key"),
            ("profile_key", prof, "profile_key", "fk:profile_key")]),
    ]
    return Q.report(parts)


# ---------------------------------------------------------------- result marts

def _marts(spark: SparkSession, sf_dir: str) -> str:
    return f"{scratch_dir(spark)}/marts/{hashlib.sha256(str(sf_dir).encode()).hexdigest()[:16]}"


def q_mart_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as a Parquet mart under the shared folder, read back.

    There is one mart per input folder and no freshness window: every call
    computes a new version from the tables, and the last few stay readable.
    """
    return report_mart(spark, _marts(spark, sf_dir), "share_of_total", lambda: q_share_of_total(spark, sf_dir), ttl_seconds=-1)


def q_mart_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status and priority as a mart of partial sums per year.

    The mart is made of all years but the last and then refreshed with all: the
    second step computes the last year alone.
    """
    fact = ts.orders_fact(spark, sf_dir, extra=["o_orderstatus", "o_orderpriority"])
    days = fact.agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi")).first()
    years = range(days.lo // 10000, days.hi // 10000 + 1) if days.lo else [0]
    parts = {str(y): fact.filter(F.col("date_key").between(y * 10000, y * 10000 + 9999)) for y in years}
    root, name = _marts(spark, sf_dir), f"orders-{uuid.uuid4().hex}"
    groups = ["o_orderstatus", "o_orderpriority"]
    if len(parts) > 1:
        sum_mart(spark, root, name, {y: df for y, df in parts.items() if y != str(years[-1])}, groups, ts.ORDER_MEASURES)
    return sum_mart(spark, root, name, parts, groups, ts.ORDER_MEASURES)


# ---------------------------------------------------------------- keys that stay, whole orders

def q_key_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers of the orders as members with keys, over two loads.

    The first load has the orders of the first month that the dates touch, the
    second all orders: customers of the first keep their keys, and only the
    others are numbered, above them.  ``first_load`` tells the load of a key.
    """
    orders = ts.table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"))
    month = orders.agg(F.trunc(F.min("d"), "month").alias("m"))
    spec = {"customer": (["o_custkey"], "customer_key")}
    early = orders.join(F.broadcast(month), F.trunc("d", "month") == F.col("m")).select("o_custkey")
    first = stage(number_members(early, spec)["customer"].frame, "registry")
    second = number_members(orders.select("o_custkey"), spec, known={"customer": first})["customer"].frame
    old = first.select(F.col("customer_key").alias("old_key"))
    return second.join(old, F.col("customer_key") == F.col("old_key"), "left").select(
        "customer_key", "o_custkey", F.when(F.col("old_key").isNull(), 2).otherwise(1).alias("first_load"))


def q_customer_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with orders, ranked by their number, ties included, with its share of all."""
    orders = ts.orders_fact(spark, sf_dir, extra=["o_custkey"])
    agg = sum_measures(orders, ["o_custkey"], {"total_orders": "num_orders", "total_urgent": "is_urgent"})
    ranked = rank_groups(agg, "o_custkey", "total_orders", top=None, ratios={"urgent_per_order": ("total_urgent", "total_orders", 4)})
    return share_of_total(ranked, "total_orders", "pct_orders", 4, few=False)


def q_order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order against the one before it, and the average of seven, over all orders by key."""
    orders = ts.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    change = period_change(orders, "o_orderkey", "cents", "prev_cents", "change_cents", "pct_change", 2, calendar=False)
    return moving_average(change, "o_orderkey", "cents", "moving_avg_7", 7, 2, calendar=False)


QUERIES = {
    "dim_date": q_dim_date,
    "dim_time": q_dim_time,
    "insert_if_absent": q_insert_if_absent,
    "entity_ranking": q_entity_ranking,
    "month_trend": q_month_trend,
    "moving_average_7": q_moving_average_7,
    "series_long": q_series_long,
    "weekday_band_profile": q_weekday_band_profile,
    "weekday_band_matrix": q_weekday_band_matrix,
    "top_members_per_group": q_top_members_per_group,
    "drilldown": q_drilldown,
    "group_list": q_group_list,
    "share_of_total": q_share_of_total,
    "measure_ranking": q_measure_ranking,
    "kpi": q_kpi,
    "kpi_severity": q_kpi_severity,
    "profile_of_severe": q_profile_of_severe,
    "clean_text": q_clean_text,
    "coerce_numeric": q_coerce_numeric,
    "parse_date": q_parse_date,
    "time_key_rules": q_time_key_rules,
    "enrich_left": q_enrich_left,
    "dim_location": q_dim_location,
    "dim_descriptor": q_dim_descriptor,
    "dim_profile": q_dim_profile,
    "fact_keyed": q_fact_keyed,
    "load_summary": q_load_summary,
    "null_key_report": q_null_key_report,
    "top_check": q_top_check,
    "constraint_report": q_constraint_report,
    "mart_round_trip": q_mart_round_trip,
    "mart_merge": q_mart_merge,
    "key_registry": q_key_registry,
    "customer_ranking": q_customer_ranking,
    "order_series": q_order_series,
}

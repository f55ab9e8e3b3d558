"""Plan checks: the physical plans have the shape the design relies on."""

import io
import contextlib

import __spark_entry__ as E
from incidentmart.constants import RANKED_VEHICLES
from incidentmart.operators.measures import rank_groups, top_n_per_group
from incidentmart.operators.reshape import unpivot_totals

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_rank_limit_runs_before_window(spark):
    # Only the top-k rows reach the (single-partition) window.
    df = spark.range(1000).selectExpr("cast(id as string) as g", "id % 37 as m")
    p = plan(rank_groups(df, "g", "m", 10), "simple")
    assert "TakeOrderedAndProject" in p
    assert p.index("Window") < p.index("TakeOrderedAndProject")


def test_top_n_per_group_uses_window_group_limit(spark):
    # The rank filter becomes a WindowGroupLimit on both sides of the shuffle.
    df = spark.range(1000).selectExpr("id % 7 as p", "cast(id as string) as l", "id % 13 as m")
    p = plan(top_n_per_group(df, ["p"], "l", "m", 3), "simple")
    assert p.count("WindowGroupLimit") >= 2


def test_unpivot_totals_is_one_scan(spark, tmp_path):
    # All vehicle totals come from ONE aggregate over ONE scan.
    cols = ", ".join(f"{c} smallint" for _, c in RANKED_VEHICLES)
    path = str(tmp_path / "f")
    spark.createDataFrame([tuple(range(10))], cols).write.parquet(path)
    p = plan(unpivot_totals(spark.read.parquet(path), RANKED_VEHICLES, "t", "v", "r"), "simple")
    assert p.count("FileScan parquet") == 1 and p.count("HashAggregate") == 2


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(E.queries()["profile_of_severe"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), In(event_type, [error,purchase])" in p \
        or "In(event_type, [error,purchase])" in p
    q4 = plan(E.queries()["weekday_band_profile"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in q4


def test_facts_are_aggregated_before_the_dimension_joins(spark):
    # The scan feeds a partial aggregate on both keys; joins come above it.
    simple = plan(E.queries()["weekday_band_profile"](spark, SF), "simple")
    lines = simple.splitlines()
    joins = [i for i, x in enumerate(lines) if "Join" in x]
    partial = [i for i, x in enumerate(lines) if "partial_sum" in x and "date_key" in x and "time_key" in x]
    assert len(joins) == 2 and partial and min(partial) > max(joins[:1])


def test_no_query_is_cut_by_date(spark):
    for name in ("weekday_band_profile", "share_of_total", "kpi", "month_trend", "moving_average_7"):
        p = plan(E.queries()[name](spark, SF))
        assert "GreaterThan" not in p and "LessThan" not in p, name


def test_bounds_scan_events_once(spark):
    assert plan(E.queries()["insert_if_absent"](spark, SF), "simple").count("events.parquet") == 0


def test_join_choice_follows_the_data(spark, tmp_path):
    # No verdict is kept between plans: a dimension that grew is not broadcast.
    from incidentmart.operators.joins import through_dimensions

    def joined(rows):
        path = str(tmp_path / "dim")
        spark.range(rows).selectExpr("id AS k", "concat('name ', id) AS label").write.mode("overwrite").parquet(path)
        fact = spark.range(1000).selectExpr("id AS k", "1 AS one")
        return plan(through_dimensions(fact, [(spark.read.parquet(path), "k", ["label"])], {"n": "one"}), "simple")

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        small, grown = joined(10), joined(50_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BuildRight" in small
    assert "BroadcastHashJoin [k" not in grown or "BuildLeft" in grown

"""Every row of a table counts, whatever its date or keys, and sessions are left alone."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from incidentmart.session import get_spark

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shifted(spark, tmp_path_factory):
    """The tables with half of the events moved by 2 years, half of the orders by 20, and some orphan orders."""
    root = str(tmp_path_factory.mktemp("shifted"))
    for name in ("customer", "nation", "region", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.expr("ts + INTERVAL 2 YEARS")).otherwise(F.col("ts"))) \
        .write.parquet(f"{root}/events.parquet")
    od = spark.read.parquet(f"{SF}/orders.parquet")
    od.withColumns({
        "o_orderdate": F.when(F.col("o_orderkey") % 2 == 0, F.expr("o_orderdate + INTERVAL 20 YEARS")).otherwise(F.col("o_orderdate")),
        "o_custkey": F.when(F.col("o_orderkey") % 100 == 1, F.lit(10**9)).otherwise(F.col("o_custkey"))}) \
        .write.parquet(f"{root}/orders.parquet")
    return root


def total(spark, root, query, column):
    return E.queries()[query](spark, root).agg(F.sum(column)).first()[0]


def test_every_row_is_in_the_totals(spark, shifted):
    events = spark.read.parquet(f"{shifted}/events.parquet").count()
    orders = spark.read.parquet(f"{shifted}/orders.parquet").count()
    for query in ("kpi", "share_of_total", "weekday_band_profile", "mart_round_trip"):
        assert total(spark, shifted, query, "total_events") == events, query
    for query in ("month_trend", "moving_average_7", "load_summary"):
        assert total(spark, shifted, query, "total_orders") == orders, query
    assert E.queries()["fact_keyed"](spark, shifted).count() == orders


def test_orphans_show_as_violations(spark, shifted):
    orphans = spark.read.parquet(f"{shifted}/orders.parquet").filter("o_custkey = 1000000000").count()
    assert orphans > 0
    assert E.queries()["fact_keyed"](spark, shifted).filter("location_key IS NULL").count() == orphans
    rules = {(r.table_name, r.rule): r.violations for r in E.queries()["constraint_report"](spark, shifted).collect()}
    assert rules["fact", "fk:location_key"] == rules["fact", "not_null:location_key"] == orphans
    assert rules["fact", "fk:date_key"] > 0            # the injected ones


def test_new_files_are_seen(spark, tmp_path):
    root = str(tmp_path)
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.limit(10).write.parquet(f"{root}/events.parquet")
    assert total(spark, root, "kpi", "total_events") == 10
    ev.limit(5).write.mode("append").parquet(f"{root}/events.parquet")
    assert total(spark, root, "kpi", "total_events") == 15


def test_a_running_session_is_not_changed(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    try:
        get_spark("local[2]", shuffle_partitions=8)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_queries_make_no_folder_outside_the_shared_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.mkdtemp", None)
    assert E.queries()["mart_round_trip"](spark, SF).count() == 5


def test_local_folders_are_refused_on_a_cluster():
    from incidentmart.staging import warehouse_scratch

    assert warehouse_scratch("file:/tmp/wh/", "local[4]") == "file:/tmp/wh/_scratch"
    assert warehouse_scratch("hdfs://n/wh", "yarn") == "hdfs://n/wh/_scratch"
    for folder in ("/tmp/wh", "file:/tmp/wh"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            warehouse_scratch(folder, "spark://host:7077")

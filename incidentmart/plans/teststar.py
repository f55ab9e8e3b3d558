"""The analog star over the driver test tables.

The incident warehouse has one fact row per accident; the driver tables are
re-read here as the same kind of star so every report operator runs on them:

* ``events``  -> fact with ``date_key`` / ``time_key`` from ``ts``, measures
  ``total_events`` (1 per row), ``total_errors`` (event_type = error) and
  ``total_purchases`` (event_type = purchase); location via the customer's
  nation and region.
* ``orders``  -> fact with ``date_key`` from ``o_orderdate``, measures
  ``total_orders``, ``total_urgent`` (priority 1-URGENT), ``total_finished``
  (status F); location via customer -> nation -> region.

No row is filtered by date: the calendars are made from the dates in the data.

Definitions here are this project's own; they mirror the shape of the
incident star, not any published figure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_key, time_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("d"))


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))


def events_fact(spark: SparkSession, sf_dir: str, extra: list[str] | None = None,
                where=None) -> DataFrame:
    """Event rows keyed like the incident fact.

    ``where`` is a predicate on the raw columns, applied before projection so
    it can be pushed to the scan.
    """
    ev = table(spark, sf_dir, "events")
    if where is not None:
        ev = ev.filter(where)
    hour = F.coalesce(F.hour("ts"), F.lit(0))
    minute = F.coalesce(F.minute("ts"), F.lit(0))
    return ev.select(
        *(extra or []),
        date_key(F.to_date("ts")).alias("date_key"),
        time_key(hour, minute).alias("time_key"),
        F.lit(1).alias("num_events"),
        (F.col("event_type") == "error").cast("int").alias("is_error"),
        (F.col("event_type") == "purchase").cast("int").alias("is_purchase"),
    )


EVENT_MEASURES = {"total_events": "num_events", "total_errors": "is_error",
                  "total_purchases": "is_purchase"}


def orders_fact(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        *(extra or []),
        date_key(F.to_date("o_orderdate")).alias("date_key"),
        F.lit(1).alias("num_orders"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("is_urgent"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_finished"),
    )


ORDER_MEASURES = {"total_orders": "num_orders", "total_urgent": "is_urgent",
                  "total_finished": "is_finished"}


def nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation -> region names."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def pre_aggregate_by_key(fact: DataFrame, key: str, measures: dict[str, str]) -> DataFrame:
    """Collapse the fact to one row per foreign key before a big join.

    With a dimension that grows with the data (customers), joining partial
    sums instead of fact rows shrinks the join input from #facts to #keys;
    SUM and COUNT are unchanged by it.
    """
    return fact.groupBy(key).agg(*[F.sum(c).alias(c) for c in measures.values()])

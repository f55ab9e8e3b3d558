"""Conformed calendar dimensions (D1, D2) and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import UNKNOWN_TIME_BAND, UNKNOWN_TIME_KEY, UNKNOWN_TIME_TEXT
from ..functions.calendar import (date_key, day_name, is_weekend, iso_weekday, month_name,
                                  time_band, time_key, time_text)
from ..sources.series import date_series, literal_rows

MINUTES_PER_DAY = 24 * 60



def date_dim(spark: SparkSession, first="2024-01-01", last="2024-12-31") -> DataFrame:
    """One row per day with smart key YYYYMMDD and calendar attributes."""
    return date_attributes(date_series(spark, first, last))


def date_bounds(df: DataFrame, date_col) -> DataFrame:
    """One row (lo, hi): the first and last date of ``date_col``."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))


def year_calendar_covering(df: DataFrame, date_col) -> DataFrame:
    """D1 for the data at hand: every day of every calendar year that the
    dates in ``df`` touch (January 1 of the first year to December 31 of the
    last).  The bounds come from one aggregate over ``df``; the days are
    generated from them inside the plan, nothing passes through the driver.
    An empty input gives an empty calendar."""
    return year_calendar(date_bounds(df, date_col))


def year_calendar(bounds: DataFrame) -> DataFrame:
    """D1 for one row of bounds (lo, hi): every day of the years from lo to hi."""
    days = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return date_attributes(days)


def first_month(bounds: DataFrame) -> DataFrame:
    """The days of the month of ``lo``, for one row of bounds (lo, hi)."""
    lo = bounds.select("lo")
    start = F.make_date(F.year("lo"), F.month("lo"), F.lit(1))
    days = lo.select(F.explode(F.sequence(start, F.last_day("lo"),
                                          F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return date_attributes(days)


def date_attributes(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``full_date`` column."""
    d = F.col("full_date")
    dow = iso_weekday(d)
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).cast("smallint").alias("anio"),
        F.quarter(d).cast("smallint").alias("trimestre"),
        F.month(d).cast("smallint").alias("mes_numero"),
        month_name(F.month(d)).alias("mes_nombre"),
        F.dayofmonth(d).cast("smallint").alias("dia_mes"),
        dow.cast("smallint").alias("dia_semana_numero"),
        day_name(dow).alias("dia_semana_nombre"),
        is_weekend(dow).alias("es_fin_semana"),
    )


def time_dim(spark: SparkSession) -> DataFrame:
    """One row per minute of the day (HHMM key) plus the unknown member.

    The hour x minute product comes from one range of minute-of-day numbers
    split into hour and minute, which is the same relation as a cross join of
    two series without planning one.
    """
    h = F.expr("CAST(id DIV 60 AS INT)")
    m = F.expr("CAST(id % 60 AS INT)")
    minutes = spark.range(MINUTES_PER_DAY).select(
        time_key(h, m).cast("smallint").alias("time_key"),
        h.cast("smallint").alias("hora"),
        m.cast("smallint").alias("minuto"),
        time_text(h, m).alias("hora_texto"),
        time_band(h).alias("banda_horaria"),
    )
    unknown = literal_rows(
        spark, [(UNKNOWN_TIME_KEY, UNKNOWN_TIME_KEY, UNKNOWN_TIME_KEY, UNKNOWN_TIME_TEXT,
                 UNKNOWN_TIME_BAND)],
        "time_key smallint, hora smallint, minuto smallint, hora_texto string, banda_horaria string")
    # The unknown key (-1) can never collide with an HHMM key (>= 0), so a
    # plain union equals the insert-if-absent of the unknown member.
    return minutes.unionByName(unknown)


def insert_if_absent(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``INSERT .. ON CONFLICT (key) DO NOTHING`` as a relation.

    Returns ``existing`` plus the rows of ``new`` whose key is not present
    (first row per new key).  The anti join shuffles on the key unless the
    existing side is small enough for the planner to broadcast.
    """
    fresh = new.dropDuplicates(key).join(existing.select(*key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


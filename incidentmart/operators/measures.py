"""Generic analytical operators over aggregated star data (A, W, O, P9).

Every operator takes column names, so the same code answers the incident
reports and any other star.  Windows without a partition key run on calendar
periods and on top rows, whose number is bounded, and on nothing else: what
grows with the data goes through :mod:`.ordered`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numbers import exact_ratio
from .ordered import global_rank, over_order, with_total


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_measures(df: DataFrame, group_cols: list[str], measures: dict[str, Column | str]) -> DataFrame:
    """``GROUP BY group_cols`` with ``SUM`` of each measure.

    Planned as partial (map-side) + final hash aggregation, so a hot group is
    combined before the shuffle.
    """
    aggs = [F.sum(_c(expr)).alias(name) for name, expr in measures.items()]
    return df.groupBy(*group_cols).agg(*aggs)


def rank_groups(agg: DataFrame, label: str, measure: str, top: int | None = 10,
                ratios: dict[str, tuple[str, str, int]] | None = None,
                rank_name: str = "ranking") -> DataFrame:
    """Q1 shape: ``RANK() OVER (ORDER BY measure DESC)``, ratios, first ``top``.

    The limit is applied before the window (R5): every row with a larger
    measure than a kept row is itself kept, so ranks are exact while only
    ``top`` rows reach the window.  Ties at the cut keep the smaller label.
    Without ``top`` all groups are ranked in ranges, on many tasks.
    """
    by, tie = F.col(measure).desc_nulls_first(), F.col(label).asc_nulls_last()
    if top:
        out = agg.orderBy(by, tie).limit(top).withColumn(rank_name, F.rank().over(Window.orderBy(by)))
    else:
        out = global_rank(agg, by, measure, [tie], rank_name).withColumn(rank_name, F.col(rank_name).cast("int"))
    for name, (num, den, scale) in (ratios or {}).items():
        out = out.withColumn(name, exact_ratio(num, den, scale))
    return out


def period_change(agg: DataFrame, period: str, measure: str, prev_name: str,
                  diff_name: str, pct_name: str, scale: int = 2,
                  partition: list[str] | None = None, calendar: bool = True) -> DataFrame:
    """Q2 shape: previous present period (LAG 1), difference, % change.

    The three expressions share one window specification, so Spark plans a
    single Window node.  A zero previous value gives a NULL percentage.
    Without ``partition`` one task takes the series: right for ``calendar``
    periods.  Any other series goes in ranges with a halo of one row; its
    periods must differ.
    """
    if partition or calendar:
        w = Window.partitionBy(*(partition or [])).orderBy(period)
        out = agg.withColumn(prev_name, F.lag(measure, 1).over(w))
    else:
        out = over_order(agg, [F.col(period).asc()], 1, {prev_name: lambda w: F.lag(measure, 1).over(w)})
    return (out.withColumn(diff_name, F.col(measure) - F.col(prev_name))
            .withColumn(pct_name, exact_ratio(F.col(diff_name), F.col(prev_name), scale, 100)))


def moving_average(agg: DataFrame, order: str, measure: str, name: str, rows: int = 7,
                   scale: int = 2, partition: list[str] | None = None, calendar: bool = True) -> DataFrame:
    """Q3 shape: average over the current and ``rows - 1`` preceding rows.

    The frame counts rows present, not calendar days (absent days are not
    filled in).  Sum and count over the frame feed an exact decimal division.
    ``partition`` and ``calendar`` are as in :func:`period_change`; the halo
    has ``rows - 1`` rows.
    """
    def average(w: WindowSpec) -> Column:
        w = w.rowsBetween(-(rows - 1), Window.currentRow)
        return exact_ratio(F.sum(measure).over(w), F.count(measure).over(w), scale)

    if partition or calendar:
        return agg.withColumn(name, average(Window.partitionBy(*(partition or [])).orderBy(order)))
    return over_order(agg, [F.col(order).asc()], rows - 1, {name: average})


def top_n_per_group(agg: DataFrame, partition: list[str], label: str, measure: str, n: int,
                    rank_name: str = "ranking") -> DataFrame:
    """Q5 shape: ``ROW_NUMBER() OVER (PARTITION BY .. ORDER BY measure DESC, label)``.

    The filter on the row number becomes a ``WindowGroupLimit`` on both sides
    of the shuffle, so each task forwards at most ``n`` rows per group.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(measure).desc_nulls_first(),
                                                F.col(label).asc_nulls_last())
    return agg.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)


def share_of_total(agg: DataFrame, measure: str, name: str, scale: int = 2, few: bool = True) -> DataFrame:
    """Q6 shape: ``ROUND(100 * m / SUM(m) OVER (), scale)`` on aggregated rows.

    For ``few`` groups (event types, classifications) the window runs in one
    task; any number of groups is written once and read with its total.
    """
    if few:
        return agg.withColumn(name, exact_ratio(F.col(measure), F.sum(measure).over(Window.partitionBy()), scale, 100))
    out = with_total(agg, measure, "__total")
    return out.withColumn(name, exact_ratio(F.col(measure), F.col("__total"), scale, 100)).drop("__total")


def kpi(df: DataFrame, measures: dict[str, Column | str], count_name: str | None = None) -> DataFrame:
    """One-row totals; an empty input gives one row of NULL sums."""
    aggs = [F.count(F.lit(1)).alias(count_name)] if count_name else []
    aggs += [F.sum(_c(expr)).alias(name) for name, expr in measures.items()]
    return df.agg(*aggs)


def top_k(agg: DataFrame, measure: str, k: int, label: str | None = None) -> DataFrame:
    """``ORDER BY measure DESC LIMIT k`` (ties broken by ``label``)."""
    order = [F.col(measure).desc_nulls_first()]
    if label:
        order.append(F.col(label).asc_nulls_last())
    return agg.orderBy(*order).limit(k)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of one column."""
    return df.select(column).distinct().orderBy(column)


def drilldown(df: DataFrame, column: str, value, measure: str) -> DataFrame:
    """Rows of one member, ascending by measure for presentation."""
    return df.filter(F.col(column) == F.lit(value)).orderBy(F.col(measure).asc_nulls_last())

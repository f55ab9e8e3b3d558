"""Windows over a total order without a partition key, on many tasks.

A window without ``PARTITION BY`` sends every row to one task.  Here the rows
are range-partitioned by the order, sorted and written once.  One row per
partition comes back (how many rows, its first and last value); from these
follow what each partition needs to know of those before it and which of their
last rows it needs as a halo.  Every window that remains is over one partition,
so no task sees more than its range and the halo.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..staging import stage

PART, PLACE, HALO = "__part", "__place", "__halo"


def in_ranges(df: DataFrame, order: list[Column], num_partitions: int | None, label: str) -> DataFrame:
    """``df`` range-partitioned and sorted, written once, with the number of its partition and its place there."""
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    return stage(ranged.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias(PART), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(PLACE)), label)


def global_rank(df: DataFrame, by: Column, value: str, tie_breakers: list[Column], name: str = "ranking",
                num_partitions: int | None = None) -> DataFrame:
    """``RANK() OVER (ORDER BY by)`` of every row, ties included.

    ``by`` orders by the column ``value``.  Rows are ranged by ``by`` and
    ``tie_breakers``, so a value that very many rows share is spread over
    partitions.  Inside a partition a row ranks with the first row of its value;
    where the partition's first value also ends the partition before, it ranks
    with the row where that run of equal values began, however many partitions
    ago.  NULLs tie with one another, as do NaNs.
    """
    cols = df.columns
    rows = in_ranges(df, [by, *tie_breakers], num_partitions, "rank")
    tied = F.min(PLACE).over(Window.partitionBy(PART, value))
    edge = F.struct(PLACE, F.col(f"`{value}`").alias("v"))
    edges = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.min(edge).alias("lo"), F.max(edge).alias("hi")).collect()
    starts = {r[PART]: r.first for r in rows.join(
        rows.sparkSession.createDataFrame([(r[PART], r.n - 1) for r in edges], "__p int, __last long"), F.col(PART) == F.col("__p"))
        .withColumn("first", tied).filter(F.col(PLACE) == F.col("__last")).select(PART, "first").collect()} if edges else {}
    known, before, run, last = [], 0, 0, None
    for r in sorted(edges, key=lambda r: r[PART]):                  # one row per partition
        goes_on = last is not None and _same(last[0], r.lo.v)
        known.append((r[PART], before, run if goes_on else before))
        if not (goes_on and _same(r.lo.v, r.hi.v)):
            run = before + starts[r[PART]]
        before, last = before + r.n, (r.hi.v,)
    parts = rows.sparkSession.createDataFrame(known, "__of int, __before long, __run long")
    out = rows.withColumn("__first", tied).join(F.broadcast(parts), F.col(PART) == F.col("__of"))
    rank = F.when(F.col("__first") == 0, F.col("__run")).otherwise(F.col("__before") + F.col("__first")) + 1
    return out.select(*[F.col(f"`{c}`") for c in cols], rank.alias(name))


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def with_halo(df: DataFrame, order: list[Column], rows: int, num_partitions: int | None = None) -> DataFrame:
    """``df`` in ranges of a total ``order``, each with the ``rows`` rows before it.

    Halo rows are marked in ``__halo``; ``__place`` is the place in the whole
    order.  A window of up to ``rows`` preceding rows, partitioned by ``__part``
    and ordered by ``__place``, sees what the window over everything would see.
    Partitions may be shorter than the halo, which then comes from several.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    cut = in_ranges(df, order, num_partitions, "halo")
    sizes = sorted(tuple(r) for r in cut.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect())       # one row per partition
    before, at = {}, 0
    for part, n in sizes:
        before[part], at = at, at + n
    wanted = []                                                     # at most ``rows`` per partition
    for i, (part, _) in enumerate(sizes):
        need = rows
        for source, n in reversed(sizes[:i]):
            wanted += [(source, n - 1 - k, part) for k in range(min(n, need))]
            need -= min(n, need)
            if not need:
                break
    spark = df.sparkSession
    offsets = spark.createDataFrame(list(before.items()), "__of int, __before long")
    placed = cut.join(F.broadcast(offsets), F.col(PART) == F.col("__of")).withColumn("__at", F.col("__before") + F.col(PLACE))
    moves = spark.createDataFrame(wanted, "__from int, __row long, __to int")
    halo = placed.join(F.broadcast(moves), (F.col(PART) == F.col("__from")) & (F.col(PLACE) == F.col("__row")))
    return placed.select(*cols, PART, F.col("__at").alias(PLACE), F.lit(False).alias(HALO)).unionByName(
        halo.select(*cols, F.col("__to").alias(PART), F.col("__at").alias(PLACE), F.lit(True).alias(HALO)))


def over_order(df: DataFrame, order: list[Column], rows: int, made: dict[str, Callable[[WindowSpec], Column]],
               num_partitions: int | None = None) -> DataFrame:
    """Add columns computed from a row and up to ``rows`` rows before it in a total ``order``.

    ``made`` maps a name to a function of a window, as in ``lambda w:
    F.lag("x").over(w)`` or ``lambda w: F.sum("x").over(w.rowsBetween(-6, 0))``.
    """
    near = with_halo(df, order, rows, num_partitions)
    w = Window.partitionBy(PART).orderBy(PLACE)
    out = near.select("*", *[f(w).alias(n) for n, f in made.items()])
    return out.filter(~F.col(HALO)).select(*[F.col(f"`{c}`") for c in df.columns], *made)


def with_total(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Add ``SUM(measure) OVER ()``: the rows are written once and their total is a scalar subquery."""
    rows = stage(df, "with-total")
    return rows.withColumn(name, rows.agg(F.sum(measure)).scalar())

"""Join helpers: star joins after aggregation, null-safe equi-joins.

No join is hinted.  Spark broadcasts a side by its size in bytes
(``spark.sql.autoBroadcastJoinThreshold``), at planning or by AQE from the
sizes at run time, and splits skewed partitions of the sort-merge joins that
are left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_condition(left: DataFrame, right: DataFrame,
                        pairs: list[tuple[str, str]]) -> Column:
    """``l1 <=> r1 AND l2 <=> r2 ...``; still planned as a hash equi-join."""
    return reduce(lambda a, b: a & b,
                  [left[lc].eqNullSafe(right[rc]) for lc, rc in pairs])


def through_dimensions(fact: DataFrame, dims: list[tuple[DataFrame, str, list[str]]],
                       measures: dict[str, str], how: str = "inner") -> DataFrame:
    """SUM measures of ``fact`` grouped by attributes of its dimensions.

    ``dims`` lists (dimension, key, attributes).  The fact is collapsed to one
    row per combination of keys before any join (R9): a key that holds a third
    of all rows is one partial row per task, and the joins see keys, not
    facts.  ``measures`` maps output name to fact column.
    """
    keys = [key for _, key, _ in dims]
    rows = fact.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in measures.items()])
    groups: list[str] = []
    for dim, key, attributes in dims:
        rows = rows.join(dim.select(key, *attributes), key, how)
        groups += attributes
    return rows.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in measures])

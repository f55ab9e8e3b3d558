"""Generated sources: day series (S9), literal rows (S11); the integer series (S10) is ``spark.range``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def day_count(first, last) -> int:
    return (_as_date(last) - _as_date(first)).days + 1


def date_series(spark: SparkSession, first, last, name: str = "full_date") -> DataFrame:
    """One row per calendar day in ``[first, last]``.

    Built on ``spark.range`` so the rows are generated in parallel rather than
    exploded from one array on a single task.
    """
    n = day_count(first, last)
    if n <= 0:
        raise ValueError(f"empty calendar range {first} .. {last}")
    start = F.lit(_as_date(first).isoformat()).cast("date")
    return spark.range(n).select(F.date_add(start, F.col("id").cast("int")).alias(name))


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal relation such as ``VALUES (...)``.

    Built from literal expressions in the JVM (no Python-side RDD), so using
    it in a broadcast side does not start Python workers.
    """
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t.strip()).alias(n.strip()) for v, (n, t) in zip(r, fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))

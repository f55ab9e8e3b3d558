"""Helpers shared by the operators: scratch tables, column hygiene, global row numbers."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import new_scratch, stage

__all__ = ["SPACES", "WORD", "fresh", "new_scratch", "number_rows", "own_names", "stage", "without"]

# Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def fresh(taken: list[str], *wanted: str) -> list[str]:
    """A name for each of ``wanted`` that no column of ``taken`` has, in any case."""
    used, out = {t.lower() for t in taken}, []
    for w in wanted:
        while w.lower() in used:
            w += "_"
        used.add(w.lower())
        out.append(w)
    return out


def own_names(operator):
    """``operator``, whose helper columns start with two underscores, for input that has such columns too.

    Those columns get other names on the way in, in the frame and in arguments
    that name them, and their own back on the way out.  Without such a column
    nothing is renamed and the plan is the operator's own.
    """
    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs):
        mine = [c for c in docs.columns if c.startswith("__")]
        if not mine:
            return operator(docs, *args, **kwargs)
        other = dict(zip(mine, fresh(docs.columns, *[f"input{c}" for c in mine])))

        def named(x):
            if isinstance(x, str):
                return other.get(x, x)
            return [named(y) for y in x] if isinstance(x, list) else x

        made = operator(docs.withColumnsRenamed(other), *map(named, args), **{k: named(v) for k, v in kwargs.items()})
        return made.withColumnsRenamed({new: old for old, new in other.items()})

    return run


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns whose name, in any case, is among ``names``."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def number_rows(df: DataFrame, order: list, name: str, label: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the total order ``order``.

    Rows are range-partitioned and sorted, written once, and every partition
    gets the count of the rows before it; no task sees more than its range.
    The offsets table has one row per shuffle partition, so it is broadcast.
    Rows that tie in every order column take positions in any order.
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__part", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    kept = stage(ranged, label)
    counts = kept.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.selectExpr(
        "__part AS __of", "coalesce(sum(__n) OVER (ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __before")
    return (kept.join(F.broadcast(offsets), kept["__part"] == offsets["__of"])
            .withColumn(name, F.col("__before") + F.col("__local"))
            .drop("__part", "__local", "__of", "__before"))

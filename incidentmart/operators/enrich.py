"""Catalog enrichment (J1-J4): left joins that keep every fact row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import null_safe_condition


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_many_to_one(right: DataFrame, keys: list[str], name: str = "right side") -> None:
    """J4 as a gate: the lookup side of a many-to-one join must be unique on its keys."""
    dup = duplicate_keys(right, keys).limit(1).collect()
    if dup:
        raise ValueError(f"{name}: key {keys} is not unique, e.g. {dup[0].asDict()}")


def unique_catalog(catalog: DataFrame, keys: list[str], columns: list[str], name: str) -> DataFrame:
    """J4 inside the plan: the catalog, with an error raised by the first key that repeats."""
    one = catalog.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                     F.first(F.struct(*columns)).alias("__row"))
    checked = F.when(F.col("__n") > 1, F.raise_error(F.lit(f"{name}: key {keys} is not unique"))
                     .cast(one.schema["__row"].dataType)).otherwise(F.col("__row"))
    return one.select(*keys, checked.alias("__row")).select(*keys, "__row.*")


def left_enrich(df: DataFrame, catalog: DataFrame, keys: list[str] | dict[str, str],
                columns: list[str], name: str = "catalog") -> DataFrame:
    """Add ``columns`` of ``catalog`` matched on ``keys``; unmatched -> NULL.

    Keys match null-safely (a NULL key finds the catalog's NULL-key row, as a
    dataframe merge does).  ``keys`` maps fact column -> catalog column when
    the names differ.  A catalog key that repeats fails the job (J4); nothing
    runs before the caller's own action.
    """
    pairs = list(keys.items()) if isinstance(keys, dict) else [(k, k) for k in keys]
    cat = unique_catalog(catalog, [rc for _, rc in pairs], columns, name)
    right = cat.toDF(*[f"__k{i}" for i in range(len(pairs))], *columns)
    cond_pairs = [(lc, f"__k{i}") for i, (lc, _) in enumerate(pairs)]
    out = df.join(right, null_safe_condition(df, right, cond_pairs), "left")
    return out.drop(*[f"__k{i}" for i in range(len(pairs))])

"""Dense surrogate keys in sort order (W7, O5), the registry that keeps them from
load to load, and key lookups (J5-J7) by a digest of the natural key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .enrich import assert_many_to_one
from .joins import null_safe_condition


def assign_dense_keys(df: DataFrame, sort_cols: list[str], key_name: str,
                      num_partitions: int | None = None,
                      assume_distinct: bool = False) -> DataFrame:
    """Distinct rows of ``df`` numbered 1..n in ascending ``sort_cols`` order.

    ``sort_cols`` must cover every column, so the order is total and the
    numbering is deterministic.  The rows are range-partitioned, sorted per
    partition and written once to the shared folder (so a recomputation cannot
    move rows between partitions); then each partition adds the sizes of the
    partitions before it.  No task sees more than its range, at any size; the
    offsets have one row per partition.
    """
    order = [F.col(c).asc_nulls_last() for c in sort_cols]
    rows = df if assume_distinct else df.distinct()
    ranged = (rows.repartitionByRange(num_partitions, *order) if num_partitions
              else rows.repartitionByRange(*order))
    tagged = stage(ranged.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__mid")),
        f"keys-{key_name}")
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                        F.min("__mid").alias("__first"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", "__first",
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # One row per partition: a size fixed by configuration, not by the data.
    keyed = tagged.join(F.broadcast(offsets), "__pid")
    key = (F.col("__off") + F.col("__mid") - F.col("__first") + 1).cast("int")
    return keyed.select(key.alias(key_name), *[F.col(c) for c in df.columns])


def lookup_keys(fact: DataFrame, dim: DataFrame, natural: list[str] | dict[str, str],
                key_name: str, check_unique: bool = True) -> DataFrame:
    """Left-join ``fact`` to ``dim`` on its natural key, adding ``key_name``.

    The natural key matches null-safely; a fact row without a dimension row
    keeps a NULL key.  ``check_unique`` can be skipped for dimensions numbered
    by :func:`assign_dense_keys`, which are unique by construction.
    """
    pairs = list(natural.items()) if isinstance(natural, dict) else [(c, c) for c in natural]
    right = dim.select(key_name, *[rc for _, rc in pairs])
    if check_unique:
        assert_many_to_one(right, [rc for _, rc in pairs], f"dimension {key_name}")
    right = right.toDF(key_name, *[f"__n{i}" for i in range(len(pairs))])
    cond = null_safe_condition(fact, right, [(lc, f"__n{i}") for i, (lc, _) in enumerate(pairs)])
    return fact.join(right, cond, "left").drop(*[f"__n{i}" for i in range(len(pairs))])


def digest(columns: list[str]) -> Column:
    """64 bits of a natural key; a NULL differs from every value and from its absence."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def digest_name(dimension: str) -> str:
    return f"__digest_{dimension}"


def with_digests(df: DataFrame, specs: dict[str, list[str]], of=digest) -> DataFrame:
    """``df`` with one digest column per dimension, to be written with it: lookups then move one BIGINT each."""
    return df.withColumns({digest_name(name): of(cols) for name, cols in specs.items()})


@dataclass
class Members:
    """Numbered members of a dimension: (key, natural columns) and (key, digest) of the same rows."""

    frame: DataFrame
    by_digest: DataFrame
    key: str
    natural: list[str]
    ambiguous: Callable[[], bool]

    @property
    def exact(self) -> bool:
        """All distinct natural keys of the rows they come from, members or not,
        have different digests, so that equal digests mean equal keys.  Asked by
        lookups; the first question counts the digests of all dimensions."""
        return not self.ambiguous()


def number_members(rows: DataFrame, specs: dict[str, tuple[list[str], str]], whole: bool = False,
                   known: dict[str, DataFrame] | None = None, num_partitions: int | None = None,
                   of=digest) -> dict[str, Members]:
    """Distinct natural keys of several dimensions, numbered 1..n each in sort order.

    ``specs`` maps a dimension to its natural columns, in sort order, and its
    key's name; columns that dimensions share must stand in one order.  With
    ``whole`` a key with a NULL is no member.  One grouping-sets aggregate gives
    the distinct rows of all dimensions, one range sort with the dimension in
    front numbers them, and a table of one row per dimension and partition
    carries the rows before; no task sees more than its range.

    ``known`` holds the numbered members of an earlier load (key and natural
    columns).  They keep their keys, whatever comes; only absent members get
    numbers, above the greatest key.
    """
    merged: list[str] = []
    for cols, _ in specs.values():
        merged += [c for c in cols if c not in merged]
    for name, (cols, _) in specs.items():
        if [c for c in merged if c in cols] != cols:
            raise ValueError(f"dimension {name} sorts by {cols}, which conflicts with the other dimensions")
    gid = {name: sum(1 << (len(merged) - 1 - i) for i, c in enumerate(merged) if c not in cols)
           for name, (cols, _) in specs.items()}
    if len(set(gid.values())) != len(gid):
        raise ValueError("two dimensions have the same natural columns")
    grouped = rows.groupingSets([[F.col(c) for c in cols] for cols, _ in specs.values()], *[F.col(c) for c in merged]) \
        .agg(F.grouping_id().alias("__gid"))
    hashed = F.coalesce(*[F.when(F.col("__gid") == gid[n], of(cols)) for n, (cols, _) in specs.items()])
    distinct = stage(grouped.select("*", hashed.alias("__digest")), "members")
    every, fresh, above = distinct, distinct, {}
    if whole:
        fresh = fresh.filter(" OR ".join(
            f"(__gid = {gid[n]} AND {' AND '.join(f'`{c}` IS NOT NULL' for c in cols)})" for n, (cols, _) in specs.items()))
    for name, old in (known or {}).items():
        cols, key = specs[name]
        types = {f.name: f.dataType for f in distinct.schema.fields}
        kept = old.select(F.lit(gid[name]).cast(types["__gid"]).alias("__gid"),
                          *[(F.col(c) if c in cols else F.lit(None)).cast(types[c]).alias(c) for c in merged])
        every = every.unionByName(kept.withColumn("__digest", of(cols)))
        have = old.select(*[F.col(c).alias(f"__n{i}") for i, c in enumerate(cols)])
        fresh = fresh.join(have, null_safe_condition(fresh, have, [(c, f"__n{i}") for i, c in enumerate(cols)])
                           & (F.col("__gid") == gid[name]), "left_anti")
        above[name] = old.agg(F.max(key)).first()[0] or 0

    @cache
    def shared() -> set[int]:
        return {r[0] for r in every.distinct().groupBy("__gid", "__digest").agg(F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("__gid").distinct().collect()}          # at most one row per dimension

    order = [F.col("__gid"), *[F.col(c).asc_nulls_last() for c in merged]]
    ranged = fresh.repartitionByRange(num_partitions, *order) if num_partitions else fresh.repartitionByRange(*order)
    tagged = stage(ranged.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__mid")), "numbered")
    sizes = tagged.groupBy("__gid", "__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.partitionBy("__gid").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("__gid").alias("__g"), F.col("__pid").alias("__p"), "__first",
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # One row per dimension and partition: a size fixed by configuration, not by the data.
    placed = tagged.join(F.broadcast(offsets), (F.col("__gid") == F.col("__g")) & (F.col("__pid") == F.col("__p")))
    place = F.col("__off") + F.col("__mid") - F.col("__first") + 1

    out = {}
    for name, (cols, key) in specs.items():
        own = placed.filter(F.col("__gid") == gid[name]).select((place + above.get(name, 0)).cast("int").alias(key), *cols, "__digest")
        if known and name in known:
            kept = known[name].select(F.col(key).cast("int").alias(key), *[F.col(c).cast(own.schema[c].dataType).alias(c) for c in cols])
            own = own.unionByName(kept.withColumn("__digest", of(cols)))
        out[name] = Members(own.select(key, *cols), own.select(F.col("__digest").alias(digest_name(name)), key), key, cols, partial(lambda g: g in shared(), gid[name]))
    return out


def lookup_members(fact: DataFrame, members: dict[str, Members]) -> DataFrame:
    """Add the key of every dimension to ``fact`` (J5-J7), which has their digest columns.

    The join is on one BIGINT.  Where two natural keys of a dimension share a
    digest, that dimension is joined on its real columns instead, which ``fact``
    must then have.  A row without a member keeps a NULL key.
    """
    for name, m in members.items():
        if m.exact:
            fact = fact.join(m.by_digest, digest_name(name), "left")
        else:
            fact = lookup_keys(fact, m.frame, m.natural, m.key, check_unique=False)
        fact = fact.drop(digest_name(name))
    return fact


def distinct_projections(df: DataFrame, specs: dict[str, list[str]]) -> dict[str, DataFrame]:
    """A12 for several column sets in ONE scan of ``df`` (GROUPING SETS).

    One aggregate with a grouping set per dimension replaces one DISTINCT
    job per dimension; ``grouping_id`` tells the sets apart, so a genuine
    NULL attribute is never confused with a rolled-up column.  The distinct
    rows are written once, since each set is numbered by jobs of its own.
    """
    all_cols: list[str] = []
    for cols in specs.values():
        all_cols += [c for c in cols if c not in all_cols]
    n = len(all_cols)
    sets = [[F.col(c) for c in cols] for cols in specs.values()]
    grouped = stage(df.groupingSets(sets, *[F.col(c) for c in all_cols]).agg(
        F.grouping_id().alias("__gid")), "distinct")
    out = {}
    for name, cols in specs.items():
        gid = sum(1 << (n - 1 - i) for i, c in enumerate(all_cols) if c not in cols)
        out[name] = grouped.filter(F.col("__gid") == gid).select(*cols)
    return out

"""Integrity rules as Spark jobs.

Parquet tables enforce no keys or checks, so every constraint of the
published schema becomes a count of violating rows.  Rules on one table are
evaluated in ONE aggregate pass, or while the table is written, without reading
it again; key uniqueness is one grouped count, or a bitmap per range of dense
ids; foreign keys are checked on their distinct values.  A report is a DataFrame
``(rule, table_name, violations BIGINT)``; gates turn a report into a
driver-side error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "rule string, table_name string, violations bigint"


def _violations(pred: Column) -> Column:
    return F.count_if(F.coalesce(pred, F.lit(False)))


def _stacked(one: DataFrame, table: str, names: list[str]) -> DataFrame:
    """One row of counts ``__r0, __r1, ..`` as one report row per rule."""
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(table).alias("table_name"),
                 F.col(f"__r{i}").cast("bigint").alias("violations"))
        for i, n in enumerate(names)])))


def row_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Row-level rules (NOT NULL, ranges, domains, lengths) in one pass.

    ``rules`` maps rule name -> predicate that is TRUE for a violating row.
    """
    one = df.agg(*[_violations(pred).alias(f"__r{i}") for i, pred in enumerate(rules.values())])
    return _stacked(one, table, list(rules))


def table_rules(df: DataFrame, table: str, rules: dict[str, Column], unique: dict[str, list[str]]) -> DataFrame:
    """Row rules and uniqueness rules of one table in ONE aggregate over one scan.

    ``unique`` maps rule name -> key columns; its violations are the rows beyond
    the distinct keys, a NULL counting as a value.
    """
    keys = [F.struct(*[x for c in cols for x in (F.col(c).isNull().alias(f"null_{c}"), F.col(c).alias(c))]) for cols in unique.values()]
    one = df.agg(*[(F.count(F.lit(1)) - F.count_distinct(k)).alias(f"__r{i}") for i, k in enumerate(keys)],
                 *[_violations(pred).alias(f"__r{len(keys) + i}") for i, pred in enumerate(rules.values())])
    return _stacked(one, table, [*unique, *rules])


def foreign_key_rules(df: DataFrame, table: str, foreign_keys: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Orphans per foreign key (J11, V11), found on the distinct keys.

    ``foreign_keys`` lists ``(fk column, dimension, key column, rule name)``.
    One grouping-sets aggregate counts the rows of every distinct key of all
    foreign keys; only these few rows meet the dimensions' keys, in one anti
    join.  A NULL key counts as an orphan.
    """
    names = [fk for fk, _, _, _ in foreign_keys]
    fks = df.select(*dict.fromkeys(names))
    cols = fks.columns
    kind = "bigint" if all(t in ("tinyint", "smallint", "int", "bigint") for _, t in fks.dtypes) else "string"
    gid = {c: sum(1 << (len(cols) - 1 - i) for i, x in enumerate(cols) if x != c) for c in cols}
    counts = fks.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]) \
        .agg(F.grouping_id().cast("bigint").alias("__gid"), F.count(F.lit(1)).alias("__n"))
    each = counts.select("__gid", F.coalesce(*[F.col(c).cast(kind) for c in cols]).alias("__value"), "__n")
    each = each.select(F.explode(F.array(*[
        F.when(F.col("__gid") == gid[fk], F.lit(i)) for i, fk in enumerate(names)])).alias("__rule"), "__value", "__n").filter("__rule IS NOT NULL")
    keys = reduce(DataFrame.unionByName, [
        dim.select(F.lit(i).alias("__of"), F.col(key).cast(kind).alias("__key")).distinct()
        for i, (_, dim, key, _) in enumerate(foreign_keys)])
    orphans = each.join(keys, (F.col("__rule") == F.col("__of")) & (F.col("__value") == F.col("__key")), "left_anti")
    one = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("__rule") == i, F.col("__n"))), F.lit(0)).alias(f"__r{i}")
                        for i in range(len(foreign_keys))])
    return _stacked(one, table, [rule for _, _, _, rule in foreign_keys])


class WriteMetrics:
    """What is measured of a table while it is written.

    ``watched`` is the frame to write; after that write ``rows``, ``violations``
    and ``sums`` are known, without another look at the table.  The measuring
    must be the last step before the write: its task results then count once,
    whatever executors are lost.
    """

    def __init__(self, df: DataFrame, table: str, rules: dict[str, Column], sums: dict[str, str] | None = None):
        self.table, self._rules, self._sums = table, list(rules), list(sums or {})
        self._seen = Observation()
        self.watched = df.observe(
            self._seen, F.count(F.lit(1)).alias("rows"), *[_violations(p).alias(f"r{i}") for i, p in enumerate(rules.values())],
            *[F.sum(c).cast("bigint").alias(f"s{i}") for i, c in enumerate((sums or {}).values())])

    @property
    def rows(self) -> int:
        return self._seen.get["rows"]

    @property
    def violations(self) -> dict[str, int]:
        return {n: self._seen.get[f"r{i}"] for i, n in enumerate(self._rules)}

    @property
    def sums(self) -> dict[str, int | None]:
        return {n: self._seen.get[f"s{i}"] for i, n in enumerate(self._sums)}

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r, self.table, n) for r, n in self.violations.items()], REPORT_SCHEMA)


def unique_rule(df: DataFrame, table: str, rule: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first for every key value that repeats (V1-V3)."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .filter(F.col("__n") > 1))
    return dup.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("violations")) \
        .select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), "violations")


def unique_rules(df: DataFrame, table: str, rules: dict[str, list[str]]) -> DataFrame:
    """Several uniqueness rules of one table with ONE shuffle (GROUPING SETS).

    Each rule's key set is a grouping set; ``grouping_id`` separates them,
    so the counts equal one :func:`unique_rule` per key set.
    """
    if len(rules) == 1:
        (rule, keys), = rules.items()
        return unique_rule(df, table, rule, keys)
    all_cols: list[str] = []
    for keys in rules.values():
        all_cols += [c for c in keys if c not in all_cols]
    n = len(all_cols)
    gids = {rule: sum(1 << (n - 1 - i) for i, c in enumerate(all_cols) if c not in keys)
            for rule, keys in rules.items()}
    counts = (df.groupingSets([[F.col(c) for c in keys] for keys in rules.values()],
                              *[F.col(c) for c in all_cols])
              .agg(F.grouping_id().alias("__gid"), F.count(F.lit(1)).alias("__n")))
    extra = F.when(F.col("__n") > 1, F.col("__n") - 1).otherwise(0)
    one = counts.agg(*[F.coalesce(F.sum(F.when(F.col("__gid") == g, extra)), F.lit(0))
                       .cast("bigint").alias(f"__r{i}") for i, g in enumerate(gids.values())])
    return _stacked(one, table, list(gids))


def _buckets(df: DataFrame, key: str) -> DataFrame:
    """Per range of 32,768 ids: how many rows have one, and how many ids occur.  NULL ids are one range."""
    id_ = F.col(key).cast("bigint")
    return df.groupBy(F.bitmap_bucket_number(id_).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("__n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(id_))).alias("__ids"))


def dense_unique_rule(df: DataFrame, table: str, rule: str, key: str) -> DataFrame:
    """:func:`unique_rule` of an integer key whose values are dense, like row ids (V1, V2).

    Each task keeps one bit per id in bitmaps of 4 KB, these are merged per
    range of ids, and rows beyond the bits that are set are repeats.  No id is
    shuffled.  Meant for rows that stand roughly in the order of their ids;
    scattered ids cost a bitmap per task and range.
    """
    ids = F.when(F.col("__bucket").isNull(), F.lit(1)).otherwise(F.col("__ids"))
    return _buckets(df, key).agg(F.coalesce(F.sum(F.col("__n") - ids), F.lit(0)).cast("bigint").alias("violations")) \
        .select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), "violations")


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    """(key, n): the ids that repeat; only rows of ranges with a repeat are shuffled."""
    bad = _buckets(df, key).filter("__n > __ids OR (__bucket IS NULL AND __n > 1)").select(F.col("__bucket").alias("__b"))
    rows = df.select(key).join(bad, F.bitmap_bucket_number(F.col(key).cast("bigint")).eqNullSafe(F.col("__b")), "left_semi")
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def dependency_rule(df: DataFrame, table: str, rule: str, determinant: list[str],
                    dependent: list[str]) -> DataFrame:
    """V4: determinant values that map to more than one dependent value.

    A dependent value is a row of the columns, NULL counting as a value of its
    own.  One value means that the smallest and the largest are equal, and both
    are merged on the map side: no distinct pairs are shuffled.
    """
    value = F.struct(*[x for c in dependent for x in (F.col(c).isNull().alias(f"null_{c}"), F.col(c).alias(c))])
    bad = (df.groupBy(*determinant).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
           .filter(~F.col("__lo").eqNullSafe(F.col("__hi"))))
    return bad.agg(F.count(F.lit(1)).cast("bigint").alias("violations")) \
        .select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), "violations")


def report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_null_rules(columns: list[str]) -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNull() for c in columns}


def null_counts(df: DataFrame, columns: list[str], suffix: str = "_nulls") -> DataFrame:
    """``COUNT(*) FILTER (WHERE c IS NULL)`` per column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}{suffix}")
                    for c in columns])


def enforce(rep: DataFrame, what: str = "integrity") -> None:
    """Gate: raise listing every rule with violations (one small collect)."""
    bad = rep.filter(F.col("violations") > 0).collect()
    if bad:
        lines = ", ".join(f"{r.table_name}.{r.rule}={r.violations}" for r in bad)
        raise ValueError(f"{what} check failed: {lines}")


def expect_count(found: int, expected: int, what: str = "loaded rows") -> None:
    """Reconcile a row count with the source count."""
    if found != expected:
        raise AssertionError(f"{what}: expected {expected:,} rows, found {found:,}")


def expect_rows(df: DataFrame, expected: int, what: str = "loaded rows") -> int:
    """:func:`expect_count` of a table that was not counted yet."""
    n = df.count()
    expect_count(n, expected, what)
    return n

"""Reshaping (U1-U5): wide totals to long, pivot to a fixed matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.series import literal_rows


def unpivot_totals(df: DataFrame, columns: list[tuple[str, Column | str]], label_name: str,
                   value_name: str, rank_name: str | None = None) -> DataFrame:
    """SUM of every listed column in ONE aggregate, then one row each.

    Replaces a UNION ALL of one-column scans (R8): a single pass over the
    fact produces a one-row frame, which ``unpivot`` turns into
    ``(label, value)`` rows.  NULL totals (empty input) are kept.
    """
    sums = df.agg(*[F.sum(F.col(c) if isinstance(c, str) else c).cast("bigint").alias(f"__v{i}")
                    for i, (_, c) in enumerate(columns)])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(lbl).alias(label_name), F.col(f"__v{i}").alias(value_name))
        for i, (lbl, _) in enumerate(columns)]))
    out = sums.select(stacked)
    if rank_name:
        out = out.withColumn(rank_name, F.rank().over(
            Window.orderBy(F.col(value_name).desc_nulls_first())))
    return out


def pivot_matrix(spark: SparkSession, df: DataFrame, row: str, col: str, value: str,
                 row_labels: list, col_labels: list, row_order: str | None = None) -> DataFrame:
    """Long ``(row, col, value)`` -> one row per label, one column per label.

    Every row label appears (missing rows are all NULL) and every column label
    is a column (missing cells NULL); rows with other labels are dropped, as
    a reindex to a fixed axis does.  The label list is unioned in as empty
    cells, so the whole reshape is aggregates only (no join), and the
    explicit column list avoids a distinct-values job.  Two input rows for
    one cell raise an error inside the query instead of being combined.
    """
    labels = F.array(*[F.lit(v) for v in row_labels])
    cells = (df.filter(F.col(row).isin(*row_labels))
             .groupBy(row, col)
             .agg(F.count(F.lit(1)).alias("__n"), F.first(value).alias("__v"))
             .select(row, col, F.when(F.col("__n") > 1, F.raise_error(
                 F.concat(F.lit("duplicate cell for "), F.col(row).cast("string"), F.lit(" / "),
                          F.col(col).cast("string")))).otherwise(F.col("__v")).alias(value)))
    empty = literal_rows(spark, [(lbl,) for lbl in row_labels], f"{row} string").select(
        F.col(row).cast(df.schema[row].dataType).alias(row),
        F.lit(None).cast(df.schema[col].dataType).alias(col),
        F.lit(None).cast(df.schema[value].dataType).alias(value))
    wide = (cells.unionByName(empty).groupBy(row).pivot(col, col_labels)
            .agg(F.first(value, ignorenulls=True)))
    order_col = row_order or "__ord"
    out = wide.select(F.array_position(labels, F.col(row)).cast("int").alias(order_col), row,
                      *[F.col(f"`{c}`") for c in col_labels]).orderBy(order_col)
    return out if row_order else out.drop(order_col)


def series_long(df: DataFrame, id_cols: list[str], value_cols: list[str],
                variable: str = "variable", value: str = "value") -> DataFrame:
    """Two or more series side by side -> ``(id, variable, value)`` rows."""
    cast = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols])
    return cast.unpivot(id_cols, value_cols, variable, value)

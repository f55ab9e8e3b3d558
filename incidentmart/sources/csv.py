"""Delimited-file sources (S1, S2) with a stable file-order row number."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CATALOG_FILES, INCIDENT_FILE
from ..functions.text import normalize_header
from ..staging import stage
from .warehouse import is_missing

# Where a scanned row comes from; the row number is made of these.
TAGS = ["__file", "__block", "__mid"]
_SURPLUS = "__surplus"


def read_csv(spark: SparkSession, data_dir: str, filename: str,
             multiline: bool = False, row_id: str | None = None, tagged: bool = False) -> DataFrame:
    """Read one UTF-8 CSV with a header; every column stays STRING.

    Header cells are stripped and lower-cased.  A doubled quote inside quotes
    is one quote; ``multiline`` also takes line breaks inside quotes.  A row
    with fewer cells than the header ends in NULLs; a row with more fails the
    job.  A missing file raises ``FileNotFoundError`` naming the path.
    ``tagged`` adds the columns that :func:`number_rows_in_file` needs; with
    ``row_id`` the rows are staged and numbered from 1 in file order.
    """
    path = f"{str(data_dir).rstrip('/')}/{filename}"
    reader = (spark.read.option("header", "true").option("encoding", "UTF-8").option("escape", '"')
              .option("inferSchema", "false").option("multiLine", str(multiline).lower()))
    try:
        header = reader.option("header", "false").csv(path).first()       # as text: Spark would rename a repeated name
    except AnalysisException as exc:
        if is_missing(exc):
            raise FileNotFoundError(f"input file does not exist: {path}") from exc
        raise
    if header is None:
        raise ValueError(f"{path}: no header")
    names = [normalize_header(c or f"_c{i}") for i, c in enumerate(header)]
    if len(set(names)) != len(names):
        raise ValueError(f"{path}: duplicate column names after normalising {names}")
    reader = reader.option("header", "true")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _SURPLUS]])
    df = reader.option("enforceSchema", "true").option("mode", "PERMISSIVE").schema(schema).csv(path)
    error = F.raise_error(F.concat(F.lit(f"{path}: a row has more than {len(names)} cells, the next is "), F.col(_SURPLUS)))
    # a filter stands in every plan over the file, whatever columns are selected from it
    df = df.filter(F.when(F.col(_SURPLUS).isNotNull(), error.cast("boolean")).otherwise(F.lit(True)))
    tags = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__mid")] if tagged or row_id else []
    df = df.select(*[F.col(f"`{n}`") for n in names], *tags)
    return number_rows_in_file(stage(df, "csv-rows"), row_id) if row_id else df


def number_rows_in_file(staged: DataFrame, name: str = "source_row_id") -> DataFrame:
    """Append a 1-based row number in file order (P1) to staged, tagged rows.

    ``staged`` must be written: its tags (file, split start, position in the
    scan) are then fixed.  Rows of one split are contiguous in its scan task,
    so the position inside a split is ``__mid - min(__mid)``; a table of one
    row per split carries the rows before it.  That table is small beside the
    rows and is written too, so Spark knows its size and joins it map-side:
    the rows are not shuffled.  A row whose split has no offset fails the job.
    """
    splits = staged.groupBy("__file", "__block").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    return number_from_offsets(staged, stage(split_offsets(splits), "csv-splits"), name)


def split_offsets(splits: DataFrame) -> DataFrame:
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("__file", "__block", "__first",
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))


def number_from_offsets(staged: DataFrame, offsets: DataFrame, name: str) -> DataFrame:
    cols = [c for c in staged.columns if c not in TAGS]
    placed = staged.join(offsets, ["__file", "__block"], "left")
    missing = F.raise_error(F.concat(F.lit("no offset for a split of "), F.col("__file")))
    number = F.when(F.col("__offset").isNull(), missing.cast("bigint")) \
        .otherwise(F.col("__offset") + F.col("__mid") - F.col("__first") + 1)
    return placed.select(*[F.col(f"`{c}`") for c in cols], number.cast("bigint").alias(name))


def extract(spark: SparkSession, data_dir: str, multiline: bool = False) -> dict[str, DataFrame]:
    """The yearly incident file (tagged) plus its three catalogs, as lazy frames."""
    bundle = {"atus": read_csv(spark, data_dir, INCIDENT_FILE, multiline, tagged=True)}
    for key, filename in CATALOG_FILES.items():
        bundle[key] = read_csv(spark, data_dir, filename, multiline)
    return bundle

"""Exact deduplication with two Bloom passes, in DataFrame functions only.

Pass one sets, for every row, ``PROBES`` bits of a Bloom filter and keeps the
bits that at least two rows set (map-side counts, then built-in bitmaps).  Pass
two tests each row against that filter: a row with a bit that nobody else set
has no equal, so it passes straight through.  Only the rest is shuffled,
grouped by SHA-256 and judged.  A false hit of the filter costs a shuffle of
that row, never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, own_names, stage, without

BUCKET_BITS = 1 << 15           # bits of one built-in bitmap
PROBES = 4                      # positions of 15 bits each, out of one 64-bit hash
OUT = ["keep_id", "group_size", "kept", "text_sha256"]


def _positions(h: Column) -> Column:
    return F.array(*[F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BUCKET_BITS - 1)) for i in range(PROBES)])


def _bit_is_set(bitmap: str, position: str) -> str:
    byte = f"cast(conv(hex(substring({bitmap}, cast(shiftright({position}, 3) AS int) + 1, 1)), 16, 10) AS int)"
    return f"(shiftright({byte}, cast({position} & 7 AS int)) & 1)"


def buckets_for(rows: int, bits_per_row: int, max_buckets: int) -> int:
    n = 1
    while n < max_buckets and n * BUCKET_BITS < rows * bits_per_row:
        n *= 2
    return n


def repeated_filter(keyed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, bitmap) of the bits set by two rows or more; at most ``buckets`` rows of 4 KB."""
    bits = keyed.select("__bucket", F.explode(_positions(F.col("__probe"))).alias("__bit"))
    twice = bits.groupBy("__bucket", "__bit").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return twice.groupBy(F.col("__bucket").alias("__fb")).agg(F.bitmap_construct_agg("__bit").alias("__bitmap"))


@own_names
def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits_per_row: int = 16, max_buckets: int = 1 << 15) -> DataFrame:
    """Every row of ``docs`` plus ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after deleting space and U+0009 to U+000D.
    Of equal texts the row with the most code points in the original text stays,
    then the one with the smallest id; null ids come last.

    * Null text counts as empty; empty texts are equal to one another.
    * Rows that repeat with the same id and the same text: exactly one is kept.
    * An empty table gives an empty result; an input column named like an
      output column is replaced, any other comes back as it was.
    * The filter has ``bits_per_row`` bits per row up to ``max_buckets`` bitmaps
      of 4 KB (128 MB), which bounds the broadcast.  Beyond that it fills up and
      more rows take the shuffle; the result does not change.
    """
    keep_type = docs.schema[id_col].dataType
    docs = without(docs, [c for c in OUT if c.lower() not in (id_col.lower(), text_col.lower())])
    names = docs.columns
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sha = F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)
    buckets = buckets_for(docs.count(), bits_per_row, max_buckets)

    def keyed(df: DataFrame) -> DataFrame:
        hashed = df.withColumn("__sha", sha)
        return hashed.withColumns({"__bucket": F.pmod(F.xxhash64("__sha", F.lit(0)), F.lit(buckets)),
                                   "__probe": F.xxhash64("__sha", F.lit(1))})

    bloom = stage(repeated_filter(keyed(docs.select(F.col(f"`{text_col}`"))), buckets), "exact-bloom")
    rows = keyed(docs.withColumn("__points", F.length(text).cast("long")))
    tested = rows.join(F.broadcast(bloom), rows["__bucket"] == bloom["__fb"], "left")
    hits = " + ".join(_bit_is_set("__bitmap", f"(shiftrightunsigned(__probe, {15 * i}) & {BUCKET_BITS - 1})") for i in range(PROBES))
    tested = tested.withColumn("__hit", F.coalesce(F.expr(hits), F.lit(0)) == PROBES)
    own = [F.col(f"`{c}`") for c in names]
    me = F.col(f"`{id_col}`")
    alone = tested.filter("NOT __hit").select(
        *own, me.alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("__sha").alias("text_sha256"))

    maybe = tested.filter("__hit")
    rank = F.struct((-F.col("__points")).alias("len"), me.isNull().alias("last"), me.alias("id"))
    same = maybe.groupBy("__sha", rank.alias("__rank")).agg(F.count(F.lit(1)).alias("__n"))
    groups = same.groupBy(F.col("__sha").alias("__g")).agg(
        F.sum("__n").alias("__size"), F.min(F.struct("__rank", "__n")).alias("__best")).filter("__size > 1")
    groups = stage(groups, "exact-groups")
    judged = maybe.withColumn("__rank", rank).join(groups, F.col("__sha") == F.col("__g"), "left")
    first = F.col("__g").isNull() | F.col("__rank").eqNullSafe(F.col("__best.__rank"))
    judged = judged.withColumns({"__first": first, "__ties": first & (F.coalesce(F.col("__best.__n"), F.lit(1)) > 1)})

    def out(df: DataFrame, kept: Column) -> DataFrame:
        keep = F.when(F.col("__g").isNull(), me).otherwise(F.col("__best.__rank.id"))
        return df.select(*own, keep.cast(keep_type).alias("keep_id"), F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
                         kept.alias("kept"), F.col("__sha").alias("text_sha256"))

    settled = out(judged.filter("NOT __ties"), F.col("__first"))
    # the same id and text more than once: these rows are alike, so any one of them may stay
    number = F.expr("row_number() OVER (PARTITION BY __sha ORDER BY __points)")
    repeated = out(judged.filter("__ties").withColumn("__no", number), F.col("__no") == 1)
    return alone.unionByName(settled).unionByName(repeated)

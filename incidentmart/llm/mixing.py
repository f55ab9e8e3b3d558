"""Mix sources to target weights by capped water-filling.

Every source asks for a share of the word budget in proportion to its weight.
A source whose share passes ``max_epochs`` times its size is clamped there; the
excess goes to the others by weight, again and again, until none is above its
cap.  A source then gives whole repetitions of all its documents, and for the
fraction that is left a seeded sample: its documents in the order of a keyed
hash, up to the words that are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_names, stage, without

KEY_BITS = 60
BUCKET_SHIFT = KEY_BITS - 12    # 4,096 hash ranges per source
OUT = ["size", "source_size", "target", "repeats", "taken"]


def seeded_key(key: str, seed: int):
    """60 pseudo-random bits of the row key (null counts as an empty key)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def water_level(sources: DataFrame, budget: float) -> float:
    """Words per unit of weight once clamped sources stand at their cap.

    ``sources`` has one row (weight, cap) per source.  Each round is one
    aggregate that returns three numbers; a round that clamps no further source
    is the last, so there are at most as many rounds as sources.
    """
    level, clamped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("cap") if clamped >= 0 else F.lit(False)
        row = sources.agg(F.sum(full.cast("long")).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("used"),
                          F.sum(F.when(~full, F.col("weight"))).alias("free")).first()
        if not row["free"] or row["n"] == clamped:
            return level if row["free"] else float("inf")
        clamped, level = row["n"], (budget - (row["used"] or 0.0)) / row["free"]


def mix_sources(docs: DataFrame, weights: DataFrame, size, id_col: str = "doc_id", source_col: str = "source",
                share: float = 1.5, max_epochs: float = 2.0, seed: int = 42) -> DataFrame:
    """Every row of ``docs`` plus ``size, source_size, target, repeats, taken``.

    ``size`` is the column expression of a row's words; ``weights`` has one row
    (source, weight) per source, null included.  ``share`` of all words is the
    budget; ``target`` is what the row's source gives and ``taken`` the words
    that the row gives: ``repeats`` times its size.  A source's taken words
    differ from its target by at most half of one of its rows.

    * A null source is a source; a source without a weight row gives nothing.
    * Null text has size 0 by the caller's expression; null sizes count as 0.
    * Rows with the same id are taken alike; reruns agree, in any row order.
    * An empty table gives an empty result; an input column named like an
      output column is replaced, any other comes back as it was.
    """
    sized = without(docs, [c for c in OUT if c.lower() not in (id_col.lower(), source_col.lower())]) \
        .withColumn("size", F.coalesce(size, F.lit(0)).cast("long"))
    return _take(sized, weights, id_col, source_col, share, max_epochs, seed)


@own_names
def _take(sized: DataFrame, weights: DataFrame, id_col: str, source_col: str, share: float, max_epochs: float, seed: int) -> DataFrame:
    narrow = stage(sized.select(F.col(f"`{source_col}`").alias("s"), F.col("size"), seeded_key(id_col, seed).alias("u")), "mix-rows")
    totals = narrow.groupBy("s").agg(F.sum("size").alias("source_size"))
    w = weights.select(F.col("source").alias("ws"), F.col("weight").cast("double").alias("weight"))
    sources = stage(totals.join(w, F.col("s").eqNullSafe(F.col("ws")), "left").select(
        "s", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")), "mix-sources")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources.filter("weight > 0"), share * words)
    reach = F.least(F.col("cap"), F.col("weight") * F.lit(level)) if level != float("inf") else F.col("cap")
    target = F.when(F.col("weight") > 0, reach).otherwise(F.lit(0.0))
    goal = sources.select("s", "source_size", target.alias("target")) \
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")) \
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    # the hash range of each source in which the fraction ends, then the row inside it
    ranges = narrow.groupBy("s", F.shiftright("u", BUCKET_SHIFT).alias("b")).agg(F.sum("size").alias("n"))
    sums = ranges.selectExpr("s AS rs", "b", "n", "sum(n) OVER (PARTITION BY s ORDER BY b) - n AS before")
    ends = stage(sums.join(goal, F.col("rs").eqNullSafe(F.col("s")))
                 .filter("before < rest AND rest <= before + n AND rest > 0")
                 .select(F.col("rs").alias("es"), F.col("b").alias("eb"), (F.col("rest") - F.col("before")).alias("left")), "mix-ends")
    last = narrow.join(ends, F.col("s").eqNullSafe(F.col("es")) & (F.shiftright("u", BUCKET_SHIFT) == F.col("eb")))
    last = last.groupBy("es", "eb", "left", "u").agg(F.sum("size").alias("n")).selectExpr(
        "es", "eb", "left", "u", "sum(n) OVER (PARTITION BY es ORDER BY u) - n + n / 2 AS middle")
    start = F.shiftleft(F.col("eb"), BUCKET_SHIFT)
    cuts = last.groupBy("es").agg(F.max(F.when(F.col("middle") <= F.col("left"), F.col("u") + 1).otherwise(start)).alias("cut"))
    plan = stage(goal.join(cuts, F.col("s").eqNullSafe(F.col("es")), "left").select(
        F.col("s").alias("__s"), "source_size", "target", F.col("whole").alias("__whole"), F.coalesce("cut", F.lit(0)).alias("__cut")), "mix-plan")

    taken = sized.withColumn("__u", seeded_key(id_col, seed)).join(plan, F.col(f"`{source_col}`").eqNullSafe(F.col("__s")), "left")
    return (taken.withColumn("repeats", F.col("__whole") + (F.col("__u") < F.col("__cut")).cast("long"))
            .withColumn("taken", F.col("repeats") * F.col("size"))
            .select(*[F.col(f"`{c}`") for c in sized.columns], "source_size", "target", "repeats", "taken"))

"""Windows over a whole order on many tasks equal the windows of one task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from incidentmart.operators.measures import moving_average, period_change, rank_groups, share_of_total
from incidentmart.operators.ordered import global_rank, over_order


def single(df, by):
    return sorted(map(tuple, df.withColumn("r", F.rank().over(Window.orderBy(by))).collect()), key=str)


def many(df, by, value, **more):
    return sorted(map(tuple, global_rank(df, by, value, [F.col("id").asc()], "r", **more).collect()), key=str)


VALUES = {
    "distinct": list(range(500)), "one value": [7] * 400, "few values": [i % 3 for i in range(400)],
    "a long run": [*range(50), *[60] * 600, *range(70, 120)], "runs that end a range": [i // 37 for i in range(500)],
    "nulls": [None if i % 4 == 0 else i // 9 for i in range(300)], "one row": [1], "none": [],
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("parts", [1, 7, 40])
def test_rank_with_ties(spark, kind, parts):
    df = spark.createDataFrame(list(enumerate(VALUES[kind])), "id long, v long").repartition(5)
    by = F.col("v").desc_nulls_first()
    assert many(df, by, "v", num_partitions=parts) == single(df, by)


def test_rank_of_fractions_and_text(spark):
    x = [float("nan"), 1.5, 0.0, -0.0, None, float("inf"), 1.5] * 30
    df = spark.createDataFrame([(i, v, str(v)) for i, v in enumerate(x)], "id long, v double, t string")
    assert str(many(df, F.col("v").asc(), "v", num_partitions=9)) == str(single(df, F.col("v").asc()))
    assert str(many(df, F.col("t").desc(), "t", num_partitions=9)) == str(single(df, F.col("t").desc()))


def test_rank_of_a_million_groups_has_no_single_task(spark):
    n = 1_000_000
    agg = spark.range(n).select(F.col("id").cast("string").alias("label"), (F.col("id") % 1000 * (F.col("id") % 3)).alias("m"))
    out = rank_groups(agg, "label", "m", top=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and dict(out.dtypes)["ranking"] == "int"
    got = {r.m: (r.lo, r.hi, r.n) for r in out.groupBy("m").agg(F.min("ranking").alias("lo"), F.max("ranking").alias("hi"), F.count(F.lit(1)).alias("n")).collect()}
    at = 1
    for m in sorted(got, reverse=True):
        assert got[m][:2] == (at, at)
        at += got[m][2]
    assert at == n + 1


@pytest.mark.parametrize("n", [0, 1, 5, 60])
@pytest.mark.parametrize("parts", [1, 4, 30])
def test_halo_longer_than_the_partitions(spark, n, parts):
    df = spark.createDataFrame([(i * 3, i * i % 17 if i % 5 else None) for i in range(n)], "t long, x long").repartition(3)
    w, rows = Window.orderBy("t"), 6
    want = df.select("*", F.lag("x").over(w).alias("prev"), F.sum("x").over(w.rowsBetween(-rows, 0)).alias("s"), F.lag("x", 6).over(w).alias("six"))
    got = over_order(df, [F.col("t").asc()], rows, {
        "prev": lambda w: F.lag("x").over(w), "s": lambda w: F.sum("x").over(w.rowsBetween(-rows, 0)), "six": lambda w: F.lag("x", 6).over(w)}, num_partitions=parts)
    assert sorted(got.collect()) == sorted(want.collect())


def test_change_and_average_of_a_long_series(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("t"), (F.col("id") % 13).alias("x"))
    for one, two in ((period_change(df, "t", "x", "p", "d", "c"), period_change(df, "t", "x", "p", "d", "c", calendar=False)),
                     (moving_average(df, "t", "x", "a", 7), moving_average(df, "t", "x", "a", 7, calendar=False)),
                     (share_of_total(df, "x", "s"), share_of_total(df, "x", "s", few=False))):
        assert one.columns == two.columns and sorted(one.collect()) == sorted(two.collect())
    plan = moving_average(df, "t", "x", "a", 7, calendar=False)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan

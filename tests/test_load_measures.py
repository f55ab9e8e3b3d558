"""What a load measures while it writes, and the rules that need no shuffle of rows."""

import re

import pytest
from pyspark.sql import functions as F

import incident_fixture as fx
from incidentmart.operators import keys as K
from incidentmart.operators import quality as Q
from incidentmart.plans import load as L
from incidentmart.plans import star as S
from incidentmart.sources.csv import extract


def counts(rep):
    return {r.rule: r.violations for r in rep.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- measured by the write

def test_metrics_are_those_of_the_written_rows(spark, workdir):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), (F.col("id") % 7).alias("v")).repartition(6)
    rules = {"not_null:k": F.col("k").isNull(), "small:v": F.col("v") > 4, "never": F.col("id") < 0, "unknown": F.col("k") < 5}
    seen = Q.WriteMetrics(df, "t", rules, {"total": "v"})
    seen.watched.write.parquet(f"{workdir}/t")
    stored = spark.read.parquet(f"{workdir}/t")
    assert seen.rows == stored.count() == 1000
    assert seen.violations == counts(Q.row_rules(stored, "t", rules)) == counts(seen.report(spark))
    assert seen.sums == {"total": stored.agg(F.sum("v")).first()[0]}


def test_metrics_of_an_empty_table(spark, workdir):
    seen = Q.WriteMetrics(spark.range(0).toDF("k"), "t", {"r": F.col("k").isNull()}, {"s": "k"})
    seen.watched.write.parquet(f"{workdir}/e")
    assert (seen.rows, seen.violations, seen.sums) == (0, {"r": 0}, {"s": None})


def test_load_summary_and_rows_come_from_the_write(spark, workdir):
    raw = fx.write_bundle(f"{workdir}/raw")
    res = L.run_load(spark, raw, f"{workdir}/wh")
    fact = res["tables"]["fact_accidentes"]
    assert res["rows"] == fact.count() == len(fx.default_rows())
    assert res["summary"] == L.load_summary(fact).first().asDict()


def test_measured_rules_equal_the_report_on_the_stored_star(spark, workdir):
    L.run_load(spark, fx.write_bundle(f"{workdir}/raw"), f"{workdir}/wh")
    t = L.read_star(spark, f"{workdir}/wh")
    names = set(counts(L.validation_report(t)))
    seen = Q.WriteMetrics(t["fact_accidentes"], "fact_accidentes", L.fact_rules())
    seen.watched.write.format("noop").mode("overwrite").save()
    given = L.validation_report(t, [Q.dense_unique_rule(t["fact_accidentes"], "fact_accidentes", L.PK_RULE, "accidente_id"), seen.report(spark)])
    assert set(counts(given)) == names and not any(counts(given).values())


# ---------------------------------------------------------------- foreign keys on distinct values

def test_orphans_on_distinct_keys(spark):
    fact = spark.createDataFrame([(1, 10, "x"), (1, 10, "y"), (2, 99, "x"), (None, 10, "z"), (7, None, None), (7, 10, "x")], "a int, b bigint, c string")
    da, db = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k smallint"), spark.createDataFrame([(10,)], "k int")
    dc = spark.createDataFrame([("x",), ("y",)], "k string")
    got = counts(Q.foreign_key_rules(fact, "f", [("a", da, "k", "fk:a"), ("b", db, "k", "fk:b"), ("c", dc, "k", "fk:c"), ("a", db, "k", "fk:a->b")]))
    assert got == {"fk:a": 3, "fk:b": 2, "fk:c": 2, "fk:a->b": 6}
    numbers = [("a", da, "k", "fk:a"), ("b", db, "k", "fk:b")]
    assert counts(Q.foreign_key_rules(fact, "f", numbers)) == {"fk:a": 3, "fk:b": 2}
    assert counts(Q.foreign_key_rules(fact.limit(0), "f", numbers)) == {"fk:a": 0, "fk:b": 0}
    assert counts(Q.foreign_key_rules(fact, "f", [("a", da.limit(0), "k", "fk:a")])) == {"fk:a": 6}


def test_no_fact_row_meets_a_join(spark):
    fact = spark.range(10_000).select((F.col("id") % 5).alias("a"), (F.col("id") % 3).alias("b"))
    dim = spark.range(4).toDF("k")
    rep = Q.foreign_key_rules(fact, "f", [("a", dim, "k", "fk:a"), ("b", dim, "k", "fk:b")])
    assert counts(rep) == {"fk:a": 2000, "fk:b": 0}
    text = rep._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.split("\n") if "Join" in line]
    below = text[text.index(joins[0]):]
    assert len(joins) == 1 and "LeftAnti" in joins[0] and below.index("Aggregate") < below.index("Expand")     # the aggregate is under the join


# ---------------------------------------------------------------- uniqueness without shuffling ids

@pytest.mark.parametrize("ids", [[], [1], [1, 1, 1], list(range(100_000)), [*range(70_000), 5, 69_999, 69_999], [None, 3, None, None], [-1, -1, -40_000, 2**40]])
def test_bitmaps_count_what_grouping_counts(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(3)
    want = counts(Q.unique_rule(df, "t", "pk", ["id"]))
    assert counts(Q.dense_unique_rule(df, "t", "pk", "id")) == want
    got = {r.id: r.n for r in Q.repeated_ids(df, "id").collect()}
    assert got == {i: ids.count(i) for i in set(ids) if ids.count(i) > 1} if len(ids) < 50 else sum(n - 1 for n in got.values()) == want["pk"]


def test_only_bitmaps_are_shuffled(spark):
    text = plan(Q.dense_unique_rule(spark.range(1000), "t", "pk", "id"))
    assert not re.search(r"hashpartitioning\(id", text) and "bitmap_construct_agg" in text


# ---------------------------------------------------------------- functional dependency

def test_dependency_sees_null_names(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, None, "x"), (2, "b", None), (2, "b", None), (3, None, None), (4, "a", "b"), (4, "ab", "")], "k int, n string, m string")
    assert counts(Q.dependency_rule(df, "t", "fd", ["k"], ["n", "m"])) == {"fd": 2}
    assert counts(Q.dependency_rule(df, "t", "fd", ["k"], ["n"])) == {"fd": 2}
    assert counts(Q.dependency_rule(df.limit(0), "t", "fd", ["k"], ["n"])) == {"fd": 0}


def test_several_rules_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "b"), (None, None)], "k int, v string")
    got = counts(Q.table_rules(df, "t", {"null:v": F.col("v").isNull(), "big:k": F.col("k") > 1}, {"pk": ["k"], "unique:kv": ["k", "v"], "v": ["v"]}))
    assert got == {"pk": 2, "unique:kv": 0, "v": 2, "null:v": 1, "big:k": 1}


# ---------------------------------------------------------------- keys by digest

ROWS = [("a", 1, "x"), ("a", None, "x"), (None, 1, "x"), ("a", 1, None), ("b", 2, "y"), ("a", 1, "x"), (None, None, None)]
SPECS = {"one": (["p", "q"], "one_key"), "two": (["r"], "two_key")}


def looked_up(spark, of, whole):
    base = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "id int, p string, q int, r string")
    base = K.with_digests(base, {n: cols for n, (cols, _) in SPECS.items()}, of)
    members = K.number_members(base, SPECS, whole=whole, of=of)
    return members, K.lookup_members(base, members)


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("of", [K.digest, lambda cols: F.lit(7).cast("bigint"), lambda cols: F.pmod(K.digest(cols), F.lit(2))], ids=["digest", "all collide", "some collide"])
def test_digest_lookup_equals_the_lookup_of_real_columns(spark, of, whole):
    members, fact = looked_up(spark, of, whole)
    plain = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "id int, p string, q int, r string")
    for m in members.values():
        plain = K.lookup_keys(plain, m.frame, m.natural, m.key)
    cols = ["id", "one_key", "two_key"]
    assert sorted(fact.select(cols).collect()) == sorted(plain.select(cols).collect())
    assert fact.count() == len(ROWS)
    null_keys = fact.filter("one_key IS NULL").count()
    assert null_keys == (3 if whole else 0)


def test_joins_move_one_bigint(spark, workdir):
    base = S.build_base(extract(spark, fx.write_bundle(f"{workdir}/raw")))
    base.write.parquet(f"{workdir}/base")
    base = S.numbered_base(spark.read.parquet(f"{workdir}/base"))
    members = S.build_members(base)
    assert all(m.exact for m in members.values())
    text = S.resolve_keys(base, members)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.split("\n") if "Join LeftOuter" in line and "__digest" in line]
    assert len(joins) == 3 and all(line.count("=") == 1 for line in joins)
    assert not any("tipaccid#" in line for line in text.split("\n") if "Relation" not in line)       # text columns are not even read


def test_numbering_conflicts_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="conflicts"):
        K.number_members(df, {"x": (["a", "b"], "xk"), "y": (["b", "a"], "yk")})


# ---------------------------------------------------------------- keys that stay from load to load

def test_old_members_keep_their_keys(spark):
    def load(rows, known=None):
        df = spark.createDataFrame(rows, "p string, q int, r string")
        return K.number_members(df, SPECS, known=known, num_partitions=3)

    first = load([("b", 1, "z"), ("d", 1, "z"), ("b", None, "y")])
    one = {(r.p, r.q): r.one_key for r in first["one"].frame.collect()}
    assert one == {("b", 1): 1, ("b", None): 2, ("d", 1): 3}
    second = load([("a", 1, "z"), ("b", None, "x"), ("c", 9, "z"), ("a", None, None)], {n: m.frame for n, m in first.items()})
    two = {(r.p, r.q): r.one_key for r in second["one"].frame.collect()}
    assert two == {**one, ("a", 1): 4, ("a", None): 5, ("c", 9): 6}
    assert {r.r: r.two_key for r in second["two"].frame.collect()} == {"y": 1, "z": 2, "x": 3, None: 4}
    third = load([("b", 1, "z")], {n: m.frame for n, m in second.items()})
    assert sorted(third["one"].frame.collect()) == sorted(second["one"].frame.collect())


def test_a_known_member_may_share_a_digest_with_a_new_one(spark):
    same = lambda cols: F.lit(1).cast("bigint")
    old = spark.createDataFrame([(5, "a", 1)], "one_key int, p string, q int")
    base = K.with_digests(spark.createDataFrame([("b", 2)], "p string, q int"), {"one": ["p", "q"]}, same)
    members = K.number_members(base, {"one": (["p", "q"], "one_key")}, known={"one": old}, of=same)
    assert not members["one"].exact
    assert [r.one_key for r in K.lookup_members(base, members).collect()] == [6]


def test_second_load_keeps_keys_and_adds_members(spark, workdir):
    target = f"{workdir}/wh"
    L.run_load(spark, fx.write_bundle(f"{workdir}/raw"), target)
    before = {n: {tuple(r)[1:]: r[0] for r in L.read_star(spark, target)[n].collect()} for n in S.DIMENSIONS}
    more = fx.default_rows() + [fx.row(ent="8", mun="37")]
    L.run_load(spark, fx.write_bundle(f"{workdir}/raw2", rows=more), target)
    for n in S.DIMENSIONS:
        after = {tuple(r)[1:]: r[0] for r in L.read_star(spark, target)[n].collect()}
        assert before[n].items() <= after.items()
        assert sorted(after.values()) == list(range(1, len(after) + 1))


# ---------------------------------------------------------------- layout

def test_hot_dates_are_spread_and_order_is_kept(spark, workdir):
    n = 20_000
    base = spark.range(1, n + 1).select(F.col("id").alias("source_row_id"), F.when(F.col("id") % 3 != 0, 20240105).otherwise(20240101 + F.col("id") % 28).cast("int").alias("date_key"))
    layout = L.date_layout(base, 8, n)
    laid = L.cluster_fact(base, layout, 8, n)
    assert laid.columns == base.columns and sorted(laid.collect()) == sorted(base.collect())
    parts = laid.select("*", F.spark_partition_id().alias("p")).groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("date_key", "source_row_id")).alias("lo"), F.max(F.struct("date_key", "source_row_id")).alias("hi")).orderBy("p").collect()
    assert len(parts) == 8 and max(r.n for r in parts) < 1.5 * n / 8
    days = [(r.lo.date_key, r.hi.date_key) for r in parts]
    assert all(a[1] <= b[0] for a, b in zip(days, days[1:]))
    hot = [r.p for r in laid.filter("date_key = 20240105").select(F.spark_partition_id().alias("p")).distinct().collect()]
    assert len(hot) >= 5


def test_key_joins_run_once_on_write(spark):
    n = 2_000
    base = spark.range(1, n + 1).select(F.col("id").alias("source_row_id"), F.lit(20240105).alias("date_key"))
    watched = Q.WriteMetrics(base, "below", {})
    laid = L.cluster_fact(watched.watched, L.date_layout(base, 4, n), 4, n)
    assert "rangepartitioning" not in plan(laid) and "REPARTITION_BY_NUM" in plan(laid)
    assert laid.count() == n == watched.rows

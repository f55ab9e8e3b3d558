"""Versions: loads by date range with compare-and-set, marts kept up by merging, the log below them."""

import os

import pytest
from pyspark.sql import functions as F

import incident_fixture as fx
from incidentmart.commits import CommitLog, Conflict
from incidentmart.plans import load as L
from incidentmart.plans import marts as M
from incidentmart.plans import reports as R


# ---------------------------------------------------------------- the log

def test_log_is_compare_and_set(spark, workdir):
    one, two = (CommitLog(spark, f"{workdir}/log") for _ in range(2))
    assert one.head() == (0, None)
    assert one.commit(0, {"a": "ñ"}) == 1
    assert two.head() == (1, {"a": "ñ"})
    assert two.commit(1, {"a": 2}) == 2
    with pytest.raises(Conflict):
        one.commit(1, {"a": 3})
    assert one.versions() == [1, 2] and one.read(1) == {"a": "ñ"}
    assert not [n for n in os.listdir(f"{workdir}/log") if n.startswith("_")]


def test_two_writers_that_both_looked(spark, workdir, monkeypatch):
    log = CommitLog(spark, f"{workdir}/log")
    log.commit(0, {"n": 1})
    late = CommitLog(spark, f"{workdir}/log")
    monkeypatch.setattr(late, "versions", lambda: [1])              # it looked before the other one published
    log.commit(1, {"n": "first"})
    with pytest.raises(Conflict, match="exists already"):
        late.commit(1, {"n": "second"})
    assert log.head() == (2, {"n": "first"})


def test_foreign_files_in_a_log_are_an_error(spark, workdir):
    log = CommitLog(spark, f"{workdir}/log")
    log.commit(0, {})
    open(f"{workdir}/log/part-0.parquet", "w").close()
    with pytest.raises(ValueError, match="no version log"):
        log.head()


# ---------------------------------------------------------------- loads

def rows(*days, **more):
    return [fx.row(m=str(m), d=str(d), **more) for m, d in days]


def load(spark, workdir, target, name, rows_, **more):
    return L.run_load(spark, fx.write_bundle(f"{workdir}/{name}", rows=rows_), target, num_partitions=3, **more)


def by_day(spark, target, **more):
    fact = L.read_star(spark, target, **more)["fact_accidentes"]
    return {r.date_key: r.n for r in fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("n")).collect()}


def files(target, res):
    folder = f"{target}/_runs/{res['run_id']}/fact_accidentes"
    return {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in os.listdir(folder)}


def test_a_load_replaces_its_dates_only(spark, workdir):
    target = f"{workdir}/wh"
    a = load(spark, workdir, target, "a", rows((1, 5), (1, 9), (2, 3), (2, 20), (3, 1), (3, 1)))
    before = files(target, a)
    b = load(spark, workdir, target, "b", rows((2, 3), (2, 4), (2, 4), mun="40"), replace=("2024-02-01", "2024-02-15"))
    assert by_day(spark, target) == {20240105: 1, 20240109: 1, 20240203: 1, 20240204: 2, 20240220: 1, 20240301: 2}
    assert files(target, a) == before and b["rows"] == 3
    c = load(spark, workdir, target, "c", rows((2, 4), (3, 2)), replace=("2024-02-04", "2024-03-31"))
    assert by_day(spark, target) == {20240105: 1, 20240109: 1, 20240203: 1, 20240204: 1, 20240302: 1}
    assert by_day(spark, target, version=a["version"]) == {20240105: 1, 20240109: 1, 20240203: 1, 20240220: 1, 20240301: 2}
    assert by_day(spark, target, version=b["version"])[20240204] == 2
    t = L.read_star(spark, target)
    assert t["fact_accidentes"].select("source_row_id").distinct().count() == t["fact_accidentes"].count() == 5
    assert not L.validation_report(t).filter("violations > 0").collect()
    assert L.current_run(spark, target) == c["run_id"]


def test_dates_outside_the_range_reject_the_load(spark, workdir):
    target = f"{workdir}/wh"
    load(spark, workdir, target, "a", rows((1, 5)))
    with pytest.raises(ValueError, match="1 records lie outside"):
        load(spark, workdir, target, "b", rows((2, 3), (4, 3)), replace=("2024-02-01", "2024-02-29"))
    assert by_day(spark, target) == {20240105: 1} and len(os.listdir(f"{target}/_runs")) == 1


def test_of_two_loads_from_one_parent_one_publishes(spark, workdir, monkeypatch):
    target = f"{workdir}/wh"
    load(spark, workdir, target, "a", rows((1, 5)))
    build = L._build_run

    def slow(*args):
        monkeypatch.setattr(L, "_build_run", build)
        out = build(*args)
        load(spark, workdir, target, "other", rows((1, 6), (1, 7)))
        return out

    monkeypatch.setattr(L, "_build_run", slow)
    with pytest.raises(Conflict):
        load(spark, workdir, target, "mine", rows((1, 8)))
    assert by_day(spark, target) == {20240106: 1, 20240107: 1}
    assert len(os.listdir(f"{target}/_runs")) == 2                  # the loser left nothing


def test_ranges_of_a_manifest():
    parts = [{"run_id": "a", "lo": 1, "hi": 9}, {"run_id": "b", "lo": 10, "hi": 20}]
    assert L.replaced(parts, 4, 12) == [{"run_id": "a", "lo": 1, "hi": 3}, {"run_id": "b", "lo": 13, "hi": 20}]
    assert L.replaced(parts, 12, 14) == [parts[0], {"run_id": "b", "lo": 10, "hi": 11}, {"run_id": "b", "lo": 15, "hi": 20}]
    assert L.replaced(parts, 0, 99) == [] and L.replaced(parts, 30, 40) == parts


def test_retention_keeps_what_kept_versions_need(spark, workdir):
    target = f"{workdir}/wh"
    a = load(spark, workdir, target, "a", rows((1, 5), (2, 5)))
    b = load(spark, workdir, target, "b", rows((2, 6)), replace=("2024-02-01", "2024-02-29"))
    c = load(spark, workdir, target, "c", rows((2, 7)), replace=("2024-02-01", "2024-02-29"))
    assert L.retain(spark, target, 1) == [b["run_id"]]
    assert by_day(spark, target) == {20240105: 1, 20240207: 1}
    d = load(spark, workdir, target, "d", rows((5, 5)))
    assert L.retain(spark, target, 1) == sorted([a["run_id"], c["run_id"]])
    assert by_day(spark, target) == {20240505: 1} and os.listdir(f"{target}/_runs") == [d["run_id"]]


# ---------------------------------------------------------------- marts

def test_a_frame_that_was_handed_out_still_reads(spark, workdir):
    build = lambda n: lambda: spark.range(n)
    first = M.report_mart(spark, workdir, "m", build(3), ttl_seconds=-1)
    second = M.report_mart(spark, workdir, "m", build(5), ttl_seconds=-1)
    assert (first.count(), second.count()) == (3, 5)
    for n in range(10):
        M.report_mart(spark, workdir, "m", build(n), ttl_seconds=-1)
    assert len([n for n in os.listdir(f"{workdir}/m") if not n.startswith("_")]) == M.KEEP


def test_refresh_computes_new_parts_only(spark, workdir):
    target, root, groups = f"{workdir}/wh", f"{workdir}/marts", ["date_key", "ubicacion_key"]
    measures = {"n": "num_accidentes", "total_heridos": "total_heridos"}

    def refresh():
        parts = L.fact_parts(spark, target, L.published(spark, target).head()[1])
        return M.sum_mart(spark, root, "daily", parts, groups, measures)

    def whole():
        return L.read_star(spark, target)["fact_accidentes"].groupBy(*groups).agg(*[F.sum(c).alias(n) for n, c in measures.items()])

    load(spark, workdir, target, "a", rows((1, 5), (1, 5), (2, 3), (3, 4), per={"neherido": 2}))
    one = refresh()
    handed = sorted(one.collect())
    assert handed == sorted(whole().collect())
    made = set(os.listdir(f"{root}/daily"))
    load(spark, workdir, target, "b", rows((2, 3), (2, 4), mun="41"), replace=("2024-02-01", "2024-02-29"))
    two = refresh()
    assert sorted(two.collect()) == sorted(whole().collect()) != handed
    assert sorted(one.collect()) == handed
    assert len(set(os.listdir(f"{root}/daily")) - made) == 3         # the new range, and both sides of the old one
    made = set(os.listdir(f"{root}/daily"))
    load(spark, workdir, target, "c", rows((4, 1)), replace=("2024-04-01", "2024-04-01"))
    assert sorted(refresh().collect()) == sorted(whole().collect())
    assert len(set(os.listdir(f"{root}/daily")) - made) == 3         # April cut the last range in two; January and February were reused
    made = set(os.listdir(f"{root}/daily"))
    refresh()
    assert set(os.listdir(f"{root}/daily")) == made                  # nothing new, nothing computed


def test_sums_of_nulls_and_of_another_shape(spark, workdir):
    parts = {"a": spark.createDataFrame([(1, None), (2, 3)], "g int, v int"), "b": spark.createDataFrame([(1, None), (2, None)], "g int, v int")}
    assert sorted(M.sum_mart(spark, workdir, "m", parts, ["g"], {"s": "v"}).collect()) == [(1, None), (2, 3)]
    assert M.sum_mart(spark, workdir, "m", parts, [], {"s": "v"}).collect() == [(3,)]


def test_reports_run_on_a_star_of_several_ranges(spark, workdir):
    target = f"{workdir}/wh"
    load(spark, workdir, target, "a", fx.default_rows())
    want = R.month_trend(L.read_star(spark, target)).collect()
    half = [r for r in fx.default_rows() if 1 <= int(dict(zip(fx.HEADER, r))["mes"]) <= 6]
    load(spark, workdir, target, "b", half, replace=("2024-01-01", "2024-06-30"))
    assert R.month_trend(L.read_star(spark, target)).collect() == want

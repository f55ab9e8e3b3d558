import datetime as dt

from incidentmart.constants import BAND_ORDER, DAY_NAMES, RANKED_VEHICLES
from incidentmart.operators.measures import (moving_average, period_change, rank_groups,
                                             share_of_total, top_n_per_group)
from incidentmart.operators.reshape import pivot_matrix, series_long, unpivot_totals


def test_rank_ties_and_cut(spark):
    df = spark.createDataFrame([("a", 10), ("b", 7), ("c", 7), ("d", 5), ("e", 7)], "g string, m long")
    out = rank_groups(df, "g", "m", top=3).orderBy("ranking", "g").collect()
    assert [(r.g, r.ranking) for r in out] == [("a", 1), ("b", 2), ("c", 2)]
    full = rank_groups(df, "g", "m", top=None).orderBy("ranking", "g").collect()
    assert [r.ranking for r in full] == [1, 2, 2, 2, 5]


def test_row_number_tie_break_by_label(spark):
    df = spark.createDataFrame([("x", "b", 5), ("x", "a", 5), ("x", "c", 9), ("y", "z", 1)],
                               "p string, l string, m long")
    out = top_n_per_group(df, ["p"], "l", "m", 2).orderBy("p", "ranking").collect()
    assert [(r.p, r.l, r.ranking) for r in out] == [("x", "c", 1), ("x", "a", 2), ("y", "z", 1)]


def test_moving_average_counts_rows_not_days(spark):
    rows = [(dt.date(2024, 1, d), v) for d, v in [(1, 1), (2, 2), (9, 4)]]
    df = spark.createDataFrame(rows, "d date, v long")
    out = moving_average(df, "d", "v", "ma").orderBy("d").collect()
    assert [float(r.ma) for r in out] == [1.0, 1.5, 2.33]


def test_single_period_and_zero_previous(spark):
    one = spark.createDataFrame([(1, 5)], "p int, m long")
    r = period_change(one, "p", "m", "prev", "diff", "pct").first()
    assert (r.prev, r.diff, r.pct) == (None, None, None)
    two = spark.createDataFrame([(1, 0), (2, 3)], "p int, m long")
    r = period_change(two, "p", "m", "prev", "diff", "pct").orderBy("p").collect()[1]
    assert (r.prev, r.diff, r.pct) == (0, 3, None)


def test_share_sums_to_about_100(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "g string, m long")
    vals = [float(r.s) for r in share_of_total(df, "m", "s").collect()]
    assert vals == [33.33, 33.33, 33.33]


def test_empty_fact_vehicle_ranking(spark):
    cols = ", ".join(f"{c} smallint" for _, c in RANKED_VEHICLES)
    empty = spark.createDataFrame([], cols)
    out = unpivot_totals(empty, RANKED_VEHICLES, "tipo_vehiculo", "total", "ranking").collect()
    assert len(out) == 10
    assert all(r.total is None and r.ranking == 1 for r in out)


def test_pivot_missing_band_column_is_null(spark):
    df = spark.createDataFrame([("Lunes", "Mañana", 3), ("Martes", "Noche", 1)],
                               "d string, b string, v long")
    out = pivot_matrix(spark, df, "d", "b", "v", DAY_NAMES, BAND_ORDER, row_order="n")
    rows = out.collect()
    assert len(rows) == 7 and out.columns == ["n", "d"] + BAND_ORDER
    assert rows[0]["Mañana"] == 3 and rows[0]["Sin especificar"] is None
    assert rows[6]["d"] == "Domingo" and all(rows[6][b] is None for b in BAND_ORDER)


def test_pivot_duplicate_cell_raises(spark):
    df = spark.createDataFrame([("Lunes", "Noche", 3), ("Lunes", "Noche", 4)],
                               "d string, b string, v long")
    try:
        pivot_matrix(spark, df, "d", "b", "v", DAY_NAMES, BAND_ORDER).collect()
    except Exception as exc:  # noqa: BLE001
        assert "duplicate cell" in str(exc)
    else:
        raise AssertionError("duplicate cell accepted")


def test_series_long(spark):
    df = spark.createDataFrame([(1, 2, 2.5)], "d int, a long, b double")
    out = series_long(df, ["d"], ["a", "b"]).collect()
    assert sorted((r.variable, r.value) for r in out) == [("a", 2.0), ("b", 2.5)]


def test_report_mart_reuses_fresh_rows(spark, workdir):
    from incidentmart.plans.marts import report_mart
    calls = []

    def build():
        calls.append(1)
        return spark.range(3).selectExpr("id", "id * 2 as v")

    a = report_mart(spark, workdir, "r", build, ttl_seconds=600)
    b = report_mart(spark, workdir, "r", build, ttl_seconds=600)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    assert len(calls) == 1 and a.columns == ["id", "v"]
    report_mart(spark, workdir, "r", build, ttl_seconds=-1)
    assert len(calls) == 2

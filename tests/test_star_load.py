import os

import pytest

import incident_fixture as fx
from incidentmart.plans import reports as R
from incidentmart.plans.load import current_run, read_star, run_load, validation_report
from incidentmart.schemas import STAR_SCHEMAS, matches


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    raw = fx.write_bundle(str(tmp_path_factory.mktemp("raw")))
    target = str(tmp_path_factory.mktemp("wh"))
    return raw, target, run_load(spark, raw, target, num_partitions=3)


def test_load_counts_and_golden_rows(loaded):
    _, _, res = loaded
    t = res["tables"]
    n = len(fx.default_rows())
    assert res["rows"] == n and t["fact_accidentes"].count() == n
    assert t["dim_fecha"].count() == 366 and t["dim_tiempo"].count() == 1441
    f = {r.source_row_id: r for r in t["fact_accidentes"].collect()}
    assert sorted(f) == list(range(1, n + 1))
    assert all(r.accidente_id == r.source_row_id for r in f.values())
    assert f[41].time_key == 15          # missing hour -> midnight
    assert f[42].time_key == -1 and f[43].time_key == -1
    assert f[44].date_key == 20240229
    assert f[48].automovil == 3 and f[48].camion == 0 and f[48].bicicleta == 0
    ubic = {r.ubicacion_key: r for r in t["dim_ubicacion"].collect()}
    assert ubic[f[45].ubicacion_key].municipio == "Sin especificar"
    cond = {r.conductor_key: r for r in t["dim_conductor"].collect()}
    assert cond[f[46].conductor_key].edad_descripcion == "No especificada"
    assert cond[f[46].conductor_key].id_edad == 0
    c47 = cond[f[47].conductor_key]
    assert (c47.sexo, c47.aliento_alcoholico, c47.cinturon_seguridad) == \
        ("Mujer", "Sin especificar", "Sin especificar")
    assert ubic[f[47].ubicacion_key].cobertura == "NA"


def test_published_tables_match_declared_schemas(loaded):
    _, _, res = loaded
    for name, schema in STAR_SCHEMAS.items():
        assert matches(res["tables"][name], schema), name


def test_dense_sorted_dimension_keys(loaded):
    _, _, res = loaded
    for name, cols in (("dim_ubicacion", ["id_entidad", "id_municipio", "cobertura"]),
                       ("dim_accidente", ["tipo_accidente", "causa_accidente", "clasificacion"])):
        rows = res["tables"][name].orderBy(name.replace("dim_", "") + "_key").collect()
        keys = [r[0] for r in rows]
        assert keys == list(range(1, len(rows) + 1))
        assert [tuple(r[c] for c in cols) for r in rows] == \
            sorted(tuple(r[c] for c in cols) for r in rows)


def test_validation_report_clean(loaded):
    _, _, res = loaded
    rep = validation_report(res["tables"])
    assert rep.filter("violations > 0").count() == 0
    assert rep.count() > 40


def test_second_load_is_identical(spark, loaded):
    raw, target, res = loaded
    names = ("dim_fecha", "dim_tiempo", "dim_ubicacion", "dim_accidente", "dim_conductor",
             "fact_accidentes")
    before = {n: sorted(tuple(r) for r in res["tables"][n].collect()) for n in names}
    again = run_load(spark, raw, target, num_partitions=5)
    for name in names:
        assert before[name] == sorted(tuple(r) for r in again["tables"][name].collect()), name


def test_failed_load_is_never_published(spark, loaded, tmp_path):
    raw, target, res = loaded
    before = current_run(spark, target)
    bad = fx.write_bundle(str(tmp_path / "bad"), rows=fx.default_rows() + [fx.row(m="2", d="30")])
    with pytest.raises(ValueError):
        run_load(spark, bad, target)
    assert current_run(spark, target) == before
    assert read_star(spark, target)["fact_accidentes"].count() == len(fx.default_rows())


def test_invalid_date_rejects_whole_load(spark, tmp_path):
    raw = fx.write_bundle(str(tmp_path / "raw"), rows=fx.default_rows() + [fx.row(m="2", d="30"),
                                                                            fx.row(m="")])
    with pytest.raises(ValueError, match="2 records have an invalid date"):
        run_load(spark, raw, str(tmp_path / "wh"))


def test_out_of_calendar_date_fails_foreign_key(spark, tmp_path):
    raw = fx.write_bundle(str(tmp_path / "raw"), rows=fx.default_rows() + [fx.row(y="2023",
                                                                                   m="12", d="31")])
    with pytest.raises(ValueError, match="fk:date_key=1"):
        run_load(spark, raw, str(tmp_path / "wh"))


def test_duplicate_catalog_key_rejected(spark, tmp_path):
    raw = fx.write_bundle(str(tmp_path / "raw"),
                          entidad=[["19", "Nuevo León"], ["19", "NL"], ["8", "Chihuahua"]])
    with pytest.raises(ValueError, match="tc_entidad"):
        run_load(spark, raw, str(tmp_path / "wh"))


def test_same_ids_two_names_is_a_dependency_violation(spark, tmp_path):
    # Two spellings of one entity in the catalog would be a key clash; the
    # location dimension sees two names when the municipality catalog is
    # bypassed by an unknown id in one file and known in another: simulate by
    # checking the rule directly on a hand-made dimension.
    from incidentmart.operators.quality import dependency_rule
    dim = spark.createDataFrame([(1, 19, "NL", 39, "Mty", "M"), (2, 19, "Nuevo León", 39, "Mty", "M")],
                                "ubicacion_key int, id_entidad int, entidad string, "
                                "id_municipio int, municipio string, cobertura string")
    r = dependency_rule(dim, "dim_ubicacion", "fd", ["id_entidad", "id_municipio", "cobertura"],
                        ["entidad", "municipio"]).first()
    assert r.violations == 1


def test_negative_and_overflow_counts(spark, tmp_path):
    rows = fx.default_rows() + [fx.row(veh={"automovil": -1}, per={"neherido": -2})]
    raw = fx.write_bundle(str(tmp_path / "raw"), rows=rows)
    with pytest.raises(ValueError) as exc:
        run_load(spark, raw, str(tmp_path / "wh"))
    assert "nonneg:vehicles=1" in str(exc.value) and "nonneg:casualties=1" in str(exc.value)
    rows = fx.default_rows() + [fx.row(veh={"automovil": 40000})]
    raw = fx.write_bundle(str(tmp_path / "raw2"), rows=rows)
    with pytest.raises(ValueError, match="smallint:measures=1"):
        run_load(spark, raw, str(tmp_path / "wh2"))


def test_reports_on_loaded_star(spark, loaded):
    _, target, _ = loaded
    t = read_star(spark, target)
    q1 = R.entity_ranking(t).collect()
    assert [r.entidad for r in q1][:1] == ["Nuevo León"] and q1[0].ranking == 1
    assert sum(r.total_accidentes for r in q1) == 48
    q2 = R.month_trend(t).collect()
    assert len(q2) == 12 and q2[0].accidentes_mes_anterior is None
    q3 = R.daily_moving_average(t).collect()
    assert len(q3) == t["fact_accidentes"].select("date_key").distinct().count()
    q4b = R.weekday_band_matrix(spark, t)
    assert q4b.count() == 7 and len(q4b.columns) == 7
    cells = sum(v or 0 for r in q4b.collect() for v in list(r)[2:])
    q4 = R.weekday_band_profile(t).collect()
    assert cells == sum(r.total_accidentes for r in q4) == 48
    q5 = R.top_municipalities(t).collect()
    assert max(r.ranking_en_entidad for r in q5) <= 3
    q6 = R.classification_share(t).collect()
    assert abs(sum(float(r.porcentaje_accidentes) for r in q6) - 100) < 0.05
    q7 = R.vehicle_ranking(t).collect()
    assert len(q7) == 10 and q7[0].tipo_vehiculo == "Automovil"
    k = R.kpis(t).first()
    assert k.registros_fact == 48 and k.total_accidentes_texto == "48"
    assert R.driver_profile_with_victims(t).count() >= 1
    assert R.entity_list(t).count() == 2
    assert R.entity_drilldown(t, "Nuevo León").count() == 3
    assert R.daily_series_long(t).count() == 2 * len(q3)


def test_dashboard_frames(spark, loaded):
    _, target, _ = loaded
    frames = R.dashboard(spark, read_star(spark, target))
    assert frames["q1"].columns == ["ranking", "entidad", "total_accidentes"]
    assert "total_muertos" not in frames["q2"].columns
    assert frames["q4_matrix"].count() == 7
    assert frames["q5_entities"].count() == 2
    assert frames["kpis"].first().registros_fact == 48
    full = {r.entidad: r.total_accidentes for r in R.entity_ranking(read_star(spark, target)).collect()}
    assert {r.entidad: r.total_accidentes for r in frames["q1"].collect()} == full


def test_dates_outside_the_parsers_range_are_invalid(spark, tmp_path):
    raw = fx.write_bundle(str(tmp_path / "raw"), rows=fx.default_rows() + [fx.row(y="1600")])
    with pytest.raises(ValueError, match="1 records have an invalid date"):
        run_load(spark, raw, str(tmp_path / "wh"))


def test_missing_location_id_rejects_the_load(spark, tmp_path):
    raw = fx.write_bundle(str(tmp_path / "raw"), rows=fx.default_rows() + [fx.row(mun="")])
    with pytest.raises(ValueError, match="1 records lack an entity or municipality id"):
        run_load(spark, raw, str(tmp_path / "wh"))
    assert not os.listdir(tmp_path / "wh" / "_runs")       # a failed run leaves nothing behind


def test_base_is_gone_after_a_load(loaded):
    _, target, res = loaded
    assert sorted(os.listdir(os.path.join(target, "_runs", res["run_id"]))) == sorted(STAR_SCHEMAS)


def test_unreadable_log_is_an_error(spark, tmp_path):
    assert current_run(spark, str(tmp_path / "nowhere")) is None
    log = tmp_path / "wh" / "_published"
    log.mkdir(parents=True)
    (log / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        current_run(spark, str(tmp_path / "wh"))


def test_load_with_line_breaks_in_cells(spark, tmp_path):
    rows = fx.default_rows() + [fx.row(cau='Causa "x"\nen dos líneas')]
    raw = fx.write_bundle(str(tmp_path / "raw"), rows=rows)
    res = run_load(spark, raw, str(tmp_path / "wh"), multiline=True)
    assert res["rows"] == len(rows)
    causes = [r[0] for r in res["tables"]["dim_accidente"].select("causa_accidente").distinct().collect()]
    assert 'Causa "x"\nen dos líneas' in causes

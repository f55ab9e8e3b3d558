"""The published star answers SQL through spark.sql, with known answers."""

import pytest

import incident_fixture as fx
from incidentmart.plans import reports as R
from incidentmart.plans.load import register_views, run_load


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    raw = fx.write_bundle(str(tmp_path_factory.mktemp("raw")))
    target = str(tmp_path_factory.mktemp("wh"))
    run_load(spark, raw, target)
    return register_views(spark, target)


def test_incidents_of_an_entity(spark, star):
    # the fixture has 20 ordinary rows of entity 8; all others are of entity 19
    got = spark.sql("""
        SELECT u.id_entidad, count(*) AS n, count(DISTINCT u.id_municipio) AS towns
        FROM fact_accidentes f, dim_ubicacion u WHERE u.ubicacion_key = f.ubicacion_key
        GROUP BY u.id_entidad ORDER BY 1""").collect()
    assert [tuple(r) for r in got] == [(8, 20, 1), (19, 28, 4)]


def test_share_of_unknown_hours(spark, star):
    got = spark.sql("""
        SELECT t.banda_horaria, sum(f.num_accidentes) AS n FROM fact_accidentes f
        JOIN dim_tiempo t USING (time_key) WHERE f.time_key < 0 GROUP BY ALL""").collect()
    assert [tuple(r) for r in got] == [("Sin especificar", 2)]


def test_reports_can_be_queried_as_views(spark, star):
    R.entity_ranking(star).createOrReplaceTempView("ranked")
    R.vehicle_ranking(star).createOrReplaceTempView("vehicles")
    assert spark.sql("SELECT max(ranking), sum(total_accidentes) FROM ranked").first() == (2, 48)
    row = spark.sql("SELECT tipo_vehiculo FROM vehicles WHERE total = (SELECT max(total) FROM vehicles)").first()
    assert row.tipo_vehiculo == "Automovil"


def test_leap_day_is_a_thursday(spark, star):
    got = spark.sql("""SELECT d.dia_semana_nombre, f.source_row_id FROM dim_fecha d
                       LEFT SEMI JOIN fact_accidentes x ON x.date_key = d.date_key
                       JOIN fact_accidentes f ON f.date_key = d.date_key
                       WHERE d.full_date = DATE '2024-02-29'""").collect()
    assert [tuple(r) for r in got] == [("Jueves", 44)]


def test_cli_load_and_report(spark, tmp_path, capsys):
    from incidentmart.__main__ import main
    raw = fx.write_bundle(str(tmp_path / "raw"))
    assert main(["load", "--data-dir", raw, "--target", str(tmp_path / "wh")]) == 0
    assert main(["report", "kpis", "--target", str(tmp_path / "wh")]) == 0
    out = capsys.readouterr().out
    assert "48 rows published" in out and "registros_fact" in out
    assert spark.range(1).count() == 1          # the caller's session is still alive

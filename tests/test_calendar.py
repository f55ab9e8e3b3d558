from incidentmart.plans.calendar import date_dim, insert_if_absent, time_dim


def test_date_dimension_counts(spark):
    d = date_dim(spark)
    assert d.count() == 366
    assert d.columns == ["date_key", "full_date", "anio", "trimestre", "mes_numero", "mes_nombre",
                         "dia_mes", "dia_semana_numero", "dia_semana_nombre", "es_fin_semana"]
    leap = d.filter("date_key = 20240229").first()
    assert (leap.dia_semana_numero, leap.dia_semana_nombre, leap.trimestre) == (4, "Jueves", 1)
    assert d.filter("es_fin_semana").count() == 104


def test_time_dimension_counts(spark):
    t = time_dim(spark)
    assert t.count() == 1441
    bands = {r[0]: r[1] for r in t.groupBy("banda_horaria").count().collect()}
    assert bands == {"Madrugada": 360, "Mañana": 360, "Tarde": 360, "Noche": 360,
                     "Sin especificar": 1}
    unk = t.filter("time_key = -1").first()
    assert (unk.hora, unk.minuto, unk.hora_texto) == (-1, -1, "Sin esp.")


def test_insert_if_absent_is_idempotent(spark):
    jan = date_dim(spark, "2024-01-01", "2024-01-31")
    year = date_dim(spark)
    once = insert_if_absent(jan, year, ["date_key"])
    twice = insert_if_absent(once, year, ["date_key"])
    assert once.count() == twice.count() == 366

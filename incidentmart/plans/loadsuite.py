"""Registered queries over the whole load path.

The events are written as an incident file and its catalogs in the raw CSV
layout (quoted cells with doubled quotes, blanks and unknown codes included),
loaded by :func:`run_load` into a folder of the session's shared scratch space,
and read back through the published star.  The definitions of the raw columns
are this project's own; the oracle starts from the events again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import INCIDENT_FILE, CATALOG_FILES, PERSON_COLUMNS, VEHICLE_COLUMNS
from ..staging import new_scratch, stage
from . import reports as R
from . import teststar as ts
from .calendar import date_bounds
from .load import fact_parts, published, read_star, run_load, validation_report
from .marts import sum_mart


def raw_incidents(spark: SparkSession, sf_dir: str, dates: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """One raw incident per event (of ``dates``), every cell as the file has it."""
    ev = ts.table(spark, sf_dir, "events")
    if dates:
        ev = ev.filter(F.to_date("ts").between(*[F.lit(d) for d in dates]))
    eid, uid, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")

    def tag(prefix, n):
        return F.concat(F.lit(prefix), (eid % n).cast("string"))

    cells = {
        "id_entidad": 1 + uid % 32, "id_municipio": 1 + uid % 5,
        "anio": F.year("ts"), "mes": F.month("ts"), "id_dia": F.dayofmonth("ts"),
        "id_hora": F.when(eid % 50 == 1, 99).when(eid % 50 != 0, F.hour("ts")),
        "id_minuto": F.minute("ts"),
        "id_edad": F.when(eid % 40 != 0, 10 + eid % 60),
        "cobertura": F.when(uid % 2 == 0, "Municipal").otherwise(" Suburbana "),
        "tipaccid": kind, "causaacci": tag("Causa, ", 4),
        "clasacc": F.when(kind == "error", "Fatal").when(kind == "purchase", "No fatal").otherwise("Sólo daños"),
        "urbana": tag("U", 3), "suburbana": tag("S", 2), "caparod": F.lit("Pavimentada"),
        "estatus": F.lit('Cifras "definitivas"'), "sexo": F.when(eid % 3 == 0, "Mujer").when(eid % 3 == 1, "Hombre"),
        "aliento": F.when(eid % 7 == 0, "Sí").otherwise("No"), "cinturon": F.lit("NA"),
    }
    vehicles = {"automovil": 1 + eid % 2, "motociclet": F.when(eid % 5 == 0, 1).otherwise(0),
                "camioneta": F.when(eid % 11 == 0, F.lit("2.7")).otherwise(F.lit("x"))}
    people = {"nemuerto": F.when(kind == "error", 1).otherwise(0), "neherido": F.when(kind == "purchase", 2).otherwise(0)}
    cells |= {c: vehicles.get(c, F.lit(0)) for c in VEHICLE_COLUMNS}
    cells |= {c: people.get(c, F.lit(0)) for c in PERSON_COLUMNS}
    return ev.select(*[v.cast("string").alias(c.upper() if c == "anio" else c) for c, v in cells.items()])


def write_raw(spark: SparkSession, sf_dir: str, folder: str, dates: tuple[dt.date, dt.date] | None = None) -> None:
    """The raw file set of the events: incidents and three catalogs, as CSV.

    The catalogs list the codes that occur, which the events are read for once.
    """
    raw = raw_incidents(spark, sf_dir, dates)
    codes = stage(raw.groupBy("id_entidad", "id_municipio", "id_edad").agg(F.count(F.lit(1)).alias("n")), "codes")

    def save(df: DataFrame, name: str) -> None:
        df.write.option("header", True).option("escape", '"').option("quoteAll", True) \
            .option("emptyValue", "").csv(f"{folder}/{name}")

    save(raw, INCIDENT_FILE)
    two = lambda c: F.lpad(c, 2, "0")
    save(codes.select("id_entidad").distinct().select(
        "id_entidad", F.concat(F.lit("Entidad "), two("id_entidad")).alias("nom_entidad")), CATALOG_FILES["entidad"])
    save(codes.select("id_entidad", "id_municipio").distinct().select(
        "id_entidad", "id_municipio", F.concat(F.lit("Municipio "), "id_municipio").alias("nom_municipio")), CATALOG_FILES["municipio"])
    save(codes.select("id_edad").distinct().select(
        "id_edad", F.coalesce(F.concat("id_edad", F.lit(" años")), F.lit("No especificada")).alias("desc_edad")), CATALOG_FILES["edad"])


def _days(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    bounds = date_bounds(ts.event_dates(spark, sf_dir), "d").select("lo", "hi").first()
    return bounds.lo, bounds.hi


def _calendar(days: tuple[dt.date, dt.date]) -> tuple[str, str]:
    return f"{days[0].year}-01-01", f"{days[1].year}-12-31"


def load_events(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Write the raw files, load and publish them, read the published star."""
    folder = new_scratch(spark, "incident-load")
    write_raw(spark, sf_dir, f"{folder}/raw")
    run_load(spark, f"{folder}/raw", f"{folder}/warehouse", *_calendar(_days(spark, sf_dir)))
    return read_star(spark, f"{folder}/warehouse")


def q_incident_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every published table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in load_events(spark, sf_dir).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_incident_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events before the middle day loaded first, then the dates from it on as a replaced range.

    The result is the daily mart of the published star, kept up by merging: the
    second refresh reads the new range and the cut first one.
    """
    folder = new_scratch(spark, "incident-increment")
    days = _days(spark, sf_dir)
    middle = days[0] + (days[1] - days[0] + dt.timedelta(days=1)) / 2
    day = dt.timedelta(days=1)
    measures = {"total_accidentes": "num_accidentes", "total_muertos": "total_muertos", "total_heridos": "total_heridos"}
    out = None
    for name, dates in (("before", (days[0], middle - day)), ("after", (middle, days[1]))):
        if dates[0] > dates[1]:
            continue
        write_raw(spark, sf_dir, f"{folder}/{name}", dates)
        run_load(spark, f"{folder}/{name}", f"{folder}/warehouse", *_calendar(days), replace=tuple(map(str, dates)))
        parts = fact_parts(spark, f"{folder}/warehouse", published(spark, f"{folder}/warehouse").head()[1])
        out = sum_mart(spark, f"{folder}/marts", "daily", parts, ["date_key"], measures)
    return out


def q_incident_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a published star into which violations were put, the rules that find any.

    The star is loaded from the events; a copy of its tables gets wrong
    constants, signs, keys, NULLs, lengths, ranges and repeated rows, chosen by
    values that come from the events.
    """
    t = load_events(spark, sf_dir)
    dead, hurt, bike, truck = (F.col(c) for c in ("total_muertos", "total_heridos", "motocicleta", "camioneta"))
    fact = t["fact_accidentes"].withColumns({
        "num_accidentes": F.when((F.col("automovil") == 2) & (bike == 1), 2).otherwise(F.col("num_accidentes")),
        "camioneta": F.when(truck == 2, -1).otherwise(truck),
        "total_heridos": F.when((hurt == 2) & (truck == 2), -2).otherwise(hurt),
        "automovil": F.when((F.col("automovil") != 1) | (bike != 1), F.col("automovil")),
        "conductor_key": F.when((hurt != 2) | (bike != 1), F.col("conductor_key")),
        "accidente_key": F.when((dead == 1) & (bike == 1), 10**6).otherwise(F.col("accidente_key")),
        "date_key": F.when((dead == 1) & (truck == 2), 19000101).otherwise(F.col("date_key")),
        "accidente_id": F.when((dead == 1) & (truck == 2), 0).otherwise(F.col("accidente_id"))})
    place = t["dim_ubicacion"]
    twice = place.filter("id_municipio = 3")
    place = place.withColumns({
        "entidad": F.when(F.col("id_entidad") != 7, F.col("entidad")),
        "municipio": F.when(F.col("id_municipio") == 2, F.repeat(F.lit("x"), 1000)).otherwise(F.col("municipio"))})
    place = place.unionByName(twice.withColumn("municipio", F.lit("otro")))
    fecha = t["dim_fecha"].withColumns({
        "trimestre": F.when(F.col("mes_numero") == 1, 5).otherwise(F.col("trimestre")),
        "mes_nombre": F.when(F.col("mes_numero") != 2, F.col("mes_nombre"))})
    tiempo = t["dim_tiempo"].withColumn("banda_horaria", F.when(F.col("hora") == 3, "Alba").otherwise(F.col("banda_horaria")))
    dirty = {"fact_accidentes": fact, "dim_ubicacion": place, "dim_fecha": fecha, "dim_tiempo": tiempo}
    dirty = {name: stage(dirty[name], f"dirty-{name}") if name in dirty else df for name, df in t.items()}
    return validation_report(dirty).filter("violations > 0")


def q_incident_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q8, K2 of :mod:`.reports` on the loaded star, as (report, label, measure, value)."""
    t = load_events(spark, sf_dir)
    page = R.dashboard(spark, t)

    def long(report: str, df: DataFrame, labels: list[str]) -> DataFrame:
        label = F.concat_ws("|", *[F.col(c).cast("string") for c in labels])
        measures = [c for c in df.columns if c not in labels and dict(df.dtypes)[c] not in ("string", "date", "boolean")]
        wide = df.select(label.alias("label"), *[F.col(c).cast("double").alias(c) for c in measures])
        return wide.unpivot("label", measures, "measure", "value").select(F.lit(report).alias("report"), "label", "measure", "value")

    parts = [
        long("q1", R.entity_ranking(t), ["entidad"]),
        long("q2", R.month_trend(t), ["mes_numero", "mes_nombre"]),
        long("q3", R.daily_moving_average(t), ["full_date"]),
        long("q4", R.weekday_band_profile(t), ["dia_semana_numero", "dia_semana_nombre", "banda_horaria"]),
        long("q5", R.top_municipalities(t), ["entidad", "municipio"]),
        long("q6", R.classification_share(t), ["clasificacion"]),
        long("q7", R.vehicle_ranking(t), ["tipo_vehiculo"]),
        long("q8", R.driver_profile_with_victims(t), ["sexo", "edad_descripcion", "aliento_alcoholico", "cinturon_seguridad"]),
        long("k2", R.kpis_severity(t).select("registros_fact", *R.SEVERITY), []),
        long("q1_dashboard", page["q1"], ["entidad"]),
        long("q2_dashboard", page["q2"], ["mes_numero", "mes_nombre"]),
        long("q4_dashboard", page["q4"], ["dia_semana_numero", "dia_semana_nombre", "banda_horaria"]),
        long("q4_matrix", page["q4_matrix"].drop("dia_semana_numero"), ["dia_semana_nombre"]),
        long("q5_dashboard", page["q5"], ["entidad", "municipio"]),
        long("q6_dashboard", page["q6"], ["clasificacion"]),
        long("kpis_dashboard", page["kpis"], []),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {
    "incident_load": q_incident_load,
    "incident_increment": q_incident_increment,
    "incident_rules": q_incident_rules,
    "incident_reports": q_incident_reports,
}

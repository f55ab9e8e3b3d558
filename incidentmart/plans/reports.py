"""The incident reports (Q1-Q8, K1, K2) over the published star.

Each function takes the star tables (``dict`` from
:func:`incidentmart.plans.load.read_star`) and returns a DataFrame with the
published column names.  The fact is always aggregated by its foreign keys
before a dimension is joined (R9); Spark picks each join from sizes in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BAND_ORDER, DAY_NAMES, RANKED_VEHICLES
from ..functions.calendar import band_order
from ..functions.numbers import format_int
from ..operators.joins import through_dimensions
from ..operators.measures import (distinct_values, drilldown, kpi, moving_average,
                                  period_change, rank_groups, share_of_total, top_n_per_group)
from ..operators.reshape import pivot_matrix, series_long, unpivot_totals

SEVERITY = {"total_accidentes": "num_accidentes", "total_muertos": "total_muertos",
            "total_heridos": "total_heridos"}
COUNT_ONLY = {"total_accidentes": "num_accidentes"}


def _measures(severity: bool) -> dict[str, str]:
    """Full measures, or the accident count alone (the dashboard's narrowed
    copies): fewer measures also means fewer fact columns read."""
    return SEVERITY if severity else COUNT_ONLY


def through_dimension(fact: DataFrame, dim: DataFrame, key: str, group_cols: list[str],
                      measures: dict[str, str]) -> DataFrame:
    """SUM measures of ``fact`` grouped by attributes of one dimension."""
    return through_dimensions(fact, [(dim, key, group_cols)], measures)


def entity_ranking(t: dict[str, DataFrame], top: int = 10, severity: bool = True) -> DataFrame:
    """Q1: entities with most accidents, deaths/injuries per accident, top 10."""
    agg = through_dimension(t["fact_accidentes"], t["dim_ubicacion"], "ubicacion_key",
                            ["entidad"], _measures(severity))
    ratios = {"muertos_por_accidente": ("total_muertos", "total_accidentes", 4),
              "heridos_por_accidente": ("total_heridos", "total_accidentes", 4)} if severity else {}
    out = rank_groups(agg, "entidad", "total_accidentes", top, ratios=ratios)
    cols = ["ranking", "entidad", *_measures(severity), *ratios]
    return out.select(*cols).orderBy("ranking", "entidad")


def month_trend(t: dict[str, DataFrame], severity: bool = True) -> DataFrame:
    """Q2: monthly totals with previous month, difference and % change."""
    agg = through_dimension(t["fact_accidentes"], t["dim_fecha"], "date_key",
                            ["mes_numero", "mes_nombre"], _measures(severity))
    out = period_change(agg, "mes_numero", "total_accidentes", "accidentes_mes_anterior",
                        "variacion_accidentes", "variacion_porcentual_accidentes", 2)
    return out.orderBy("mes_numero")


def _daily(t: dict[str, DataFrame]) -> DataFrame:
    agg = through_dimension(t["fact_accidentes"], t["dim_fecha"], "date_key", ["full_date"],
                            {"total_accidentes": "num_accidentes"})
    return moving_average(agg, "full_date", "total_accidentes", "promedio_movil_7_dias", 7, 2)


def daily_moving_average(t: dict[str, DataFrame]) -> DataFrame:
    """Q3: accidents per day and their 7-row moving average."""
    return _daily(t).orderBy("full_date")


def daily_series_long(t: dict[str, DataFrame]) -> DataFrame:
    """Q3 as (full_date, variable, value) for plotting both series."""
    return series_long(_daily(t), ["full_date"], ["total_accidentes", "promedio_movil_7_dias"])


def _weekday_band(t: dict[str, DataFrame], severity: bool = True) -> DataFrame:
    agg = through_dimensions(t["fact_accidentes"], [
        (t["dim_fecha"], "date_key", ["dia_semana_numero", "dia_semana_nombre"]),
        (t["dim_tiempo"], "time_key", ["banda_horaria"])], _measures(severity))
    return agg.withColumn("banda_orden", band_order("banda_horaria"))


def weekday_band_profile(t: dict[str, DataFrame], severity: bool = True) -> DataFrame:
    """Q4: accidents by ISO weekday and time band, bands in presentation order."""
    return _weekday_band(t, severity).orderBy("dia_semana_numero", "banda_orden")


def weekday_band_matrix(spark: SparkSession, t: dict[str, DataFrame]) -> DataFrame:
    """7 weekdays x 5 bands of accident counts; missing cells NULL."""
    return pivot_matrix(spark, _weekday_band(t, severity=False), "dia_semana_nombre",
                        "banda_horaria",
                        "total_accidentes", DAY_NAMES, BAND_ORDER, row_order="dia_semana_numero")


def top_municipalities(t: dict[str, DataFrame], n: int = 3, severity: bool = True) -> DataFrame:
    """Q5: top ``n`` municipalities per entity (ties broken by name)."""
    agg = through_dimension(t["fact_accidentes"], t["dim_ubicacion"], "ubicacion_key",
                            ["entidad", "municipio"], _measures(severity))
    out = top_n_per_group(agg, ["entidad"], "municipio", "total_accidentes", n, "ranking_en_entidad")
    return out.select("entidad", "municipio", *_measures(severity), "ranking_en_entidad") \
        .orderBy("entidad", "ranking_en_entidad")


def entity_drilldown(t: dict[str, DataFrame], entidad: str) -> DataFrame:
    """One entity's top municipalities, ascending for a bar chart."""
    return drilldown(top_municipalities(t), "entidad", entidad, "total_accidentes")


def entity_list(t: dict[str, DataFrame]) -> DataFrame:
    """Sorted entities offered for drill-down."""
    return distinct_values(top_municipalities(t), "entidad")


def classification_share(t: dict[str, DataFrame], severity: bool = True) -> DataFrame:
    """Q6: share of accidents per classification (percent, 2 decimals)."""
    agg = through_dimension(t["fact_accidentes"], t["dim_accidente"], "accidente_key",
                            ["clasificacion"], _measures(severity))
    return share_of_total(agg, "total_accidentes", "porcentaje_accidentes", 2) \
        .orderBy(F.col("total_accidentes").desc_nulls_first(), "clasificacion")


def vehicle_ranking(t: dict[str, DataFrame], vehicles=None) -> DataFrame:
    """Q7: total per vehicle type (one scan), ranked; NULL totals on an empty fact."""
    cols = vehicles or RANKED_VEHICLES
    return unpivot_totals(t["fact_accidentes"], cols, "tipo_vehiculo", "total", "ranking") \
        .orderBy(F.col("total").desc_nulls_first(), "tipo_vehiculo")


def kpis(t: dict[str, DataFrame]) -> DataFrame:
    """K1: fact rows and accident total, with display strings."""
    out = kpi(t["fact_accidentes"], {"total_accidentes": "num_accidentes"},
              count_name="registros_fact")
    return out.select("*", format_int("registros_fact").alias("registros_fact_texto"),
                      format_int("total_accidentes").alias("total_accidentes_texto"))


def kpis_severity(t: dict[str, DataFrame]) -> DataFrame:
    """K2 (own definition of a documented KPI): accidents, deaths, injuries."""
    out = kpi(t["fact_accidentes"], SEVERITY, count_name="registros_fact")
    return out.select("*", *[format_int(c).alias(f"{c}_texto") for c in SEVERITY])


def driver_profile_with_victims(t: dict[str, DataFrame]) -> DataFrame:
    """Q8 (own definition of a documented view): driver profile of accidents
    with at least one death or injury.  The victim predicate is on stored
    fact columns, so it is pushed to the Parquet scan."""
    fact = t["fact_accidentes"].filter((F.col("total_muertos") > 0) | (F.col("total_heridos") > 0))
    return through_dimension(fact, t["dim_conductor"], "conductor_key",
                             ["sexo", "edad_descripcion", "aliento_alcoholico",
                              "cinturon_seguridad"], SEVERITY) \
        .orderBy(F.col("total_accidentes").desc_nulls_first(), "sexo", "edad_descripcion")


def top_entities_check(t: dict[str, DataFrame], k: int = 10) -> DataFrame:
    """Control aggregate printed after a load (top entities by accidents)."""
    agg = through_dimension(t["fact_accidentes"], t["dim_ubicacion"], "ubicacion_key", ["entidad"],
                            {"accidentes": "num_accidentes", "muertos": "total_muertos",
                             "heridos": "total_heridos"})
    return agg.orderBy(F.col("accidentes").desc_nulls_first(), "entidad").limit(k)


def dashboard(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every frame the dashboard page loads: KPI, the narrowed Q1-Q7 copies
    (accident counts only), the Q4b matrix and the Q5b entity list.  Each is
    lazy; write them with :func:`incidentmart.plans.marts.report_mart` to
    serve repeated page loads from Parquet."""
    q5 = top_municipalities(t, severity=False)
    return {
        "kpis": kpis(t).select("registros_fact", "total_accidentes"),
        "q1": entity_ranking(t, severity=False),
        "q2": month_trend(t, severity=False),
        "q3": daily_moving_average(t),
        "q3_long": daily_series_long(t),
        "q4": weekday_band_profile(t, severity=False),
        "q4_matrix": weekday_band_matrix(spark, t),
        "q5": q5,
        "q5_entities": distinct_values(q5, "entidad"),
        "q6": classification_share(t, severity=False),
        "q7": vehicle_ranking(t),
    }

"""Declared schemas of the six star tables (S8) and a conformance check.

Parquet stores no keys or CHECK constraints, so a schema here is the column
list with its Spark type; nullability and constraints are enforced by the
rule jobs in :mod:`incidentmart.operators.quality`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .constants import PERSON_COLUMNS, VEHICLE_COLUMNS


def _struct(cols: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, False) for n, t in cols])


S, I, L, STR = T.ShortType(), T.IntegerType(), T.LongType(), T.StringType()

DIM_FECHA = _struct([("date_key", I), ("full_date", T.DateType()), ("anio", S), ("trimestre", S),
                     ("mes_numero", S), ("mes_nombre", STR), ("dia_mes", S),
                     ("dia_semana_numero", S), ("dia_semana_nombre", STR),
                     ("es_fin_semana", T.BooleanType())])
DIM_TIEMPO = _struct([("time_key", S), ("hora", S), ("minuto", S), ("hora_texto", STR),
                      ("banda_horaria", STR)])
DIM_UBICACION = _struct([("ubicacion_key", I), ("id_entidad", S), ("entidad", STR),
                         ("id_municipio", S), ("municipio", STR), ("cobertura", STR)])
DIM_ACCIDENTE = _struct([("accidente_key", I), ("tipo_accidente", STR), ("causa_accidente", STR),
                         ("clasificacion", STR), ("zona_urbana", STR), ("zona_suburbana", STR),
                         ("capa_rodamiento", STR), ("estatus", STR)])
DIM_CONDUCTOR = _struct([("conductor_key", I), ("sexo", STR), ("id_edad", S),
                         ("edad_descripcion", STR), ("aliento_alcoholico", STR),
                         ("cinturon_seguridad", STR)])
FACT_ACCIDENTES = _struct(
    [("accidente_id", L), ("source_row_id", L), ("date_key", I), ("time_key", S),
     ("ubicacion_key", I), ("accidente_key", I), ("conductor_key", I), ("num_accidentes", S)]
    + [(c, S) for c in VEHICLE_COLUMNS.values()] + [(c, S) for c in PERSON_COLUMNS.values()])

STAR_SCHEMAS = {"dim_fecha": DIM_FECHA, "dim_tiempo": DIM_TIEMPO, "dim_ubicacion": DIM_UBICACION,
                "dim_accidente": DIM_ACCIDENTE, "dim_conductor": DIM_CONDUCTOR,
                "fact_accidentes": FACT_ACCIDENTES}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in declared order with declared types.

    Missing columns raise; casts run under ANSI mode, so a value that does
    not fit (a count above SMALLINT) raises instead of wrapping.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def matches(df: DataFrame, schema: T.StructType) -> bool:
    """Same column names, order and types (nullability is a rule, not a type)."""
    return [(f.name, f.dataType) for f in df.schema.fields] == \
        [(f.name, f.dataType) for f in schema.fields]

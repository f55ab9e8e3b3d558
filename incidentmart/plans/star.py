"""Incident star build: cleaned base (D3), derived dimensions (D4), fact.

The whole build is one lazy plan per stage.  Catalogs are joined null-safely and
must be unique, the three derived dimensions come out of ONE grouping-sets
aggregate, new members are numbered in sort order above the keys of earlier
loads, and the fact resolves its keys by a digest of each natural key that is
written with the base, so that no text column reaches the key joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (CALENDAR_NUMERIC_COLUMNS, DESCRIPTOR_COLUMNS, DRIVER_COLUMNS,
                         LOCATION_COLUMNS, PERSON_COLUMNS, SMALLINT_MAX, SMALLINT_MIN,
                         TEXT_COLUMNS, VEHICLE_COLUMNS)
from ..functions.calendar import date_key, parse_date, time_key
from ..functions.numbers import coerce_int, parse_key
from ..functions.text import clean_text
from ..operators.enrich import left_enrich
from ..operators.keys import Members, lookup_members, number_members, with_digests
from ..schemas import FACT_ACCIDENTES, conform
from ..sources.csv import TAGS, number_rows_in_file

MEASURE_SOURCE = list(VEHICLE_COLUMNS) + list(PERSON_COLUMNS)
NUMERIC_COLUMNS = CALENDAR_NUMERIC_COLUMNS + MEASURE_SOURCE

DIMENSIONS = {
    # name: (key column, natural columns in sort order, source -> target renames)
    "dim_ubicacion": ("ubicacion_key", LOCATION_COLUMNS, {c: c for c in LOCATION_COLUMNS}),
    "dim_accidente": ("accidente_key", list(DESCRIPTOR_COLUMNS.values()), DESCRIPTOR_COLUMNS),
    "dim_conductor": ("conductor_key", list(DRIVER_COLUMNS.values()), DRIVER_COLUMNS),
}

FACT_MEASURES = ["num_accidentes"] + list(VEHICLE_COLUMNS.values()) + list(PERSON_COLUMNS.values())
FACT_COLUMNS = ["accidente_id", "source_row_id", "date_key", "time_key", "ubicacion_key",
                "accidente_key", "conductor_key"] + FACT_MEASURES


# Dates that the source's parser takes; any other is an invalid date.
DATE_RANGE = ("1677-09-22", "2262-04-11")


def _catalog(df: DataFrame, keys: list[str], renames: dict[str, str]) -> DataFrame:
    return df.select(*[parse_key(k).alias(k) for k in keys],
                     *[F.col(src).alias(dst) for src, dst in renames.items()])


def build_base(bundle: dict[str, DataFrame]) -> DataFrame:
    """D3: incident rows enriched from the catalogs, cleaned and keyed.

    Order of operations follows the source semantics: catalogs are joined
    (null-safe, many-to-one enforced) before any coercion, so a missing age
    id joins as NULL and only then becomes 0; text is cleaned after the
    joins so unmatched codes get the unknown label; the time key is computed
    from coerced parts, so a missing hour is midnight and only an
    out-of-range hour is unknown.
    """
    atus = bundle["atus"]
    raw_cols = [c for c in atus.columns if c not in ("id_entidad", "id_municipio", "id_edad")]
    df = atus.select(*raw_cols,
                     parse_key("id_entidad").alias("id_entidad"),
                     parse_key("id_municipio").alias("id_municipio"),
                     parse_key("id_edad").alias("id_edad"))
    df = left_enrich(df, _catalog(bundle["entidad"], ["id_entidad"], {"nom_entidad": "entidad"}),
                     ["id_entidad"], ["entidad"], name="tc_entidad")
    df = left_enrich(df, _catalog(bundle["municipio"], ["id_entidad", "id_municipio"],
                                  {"nom_municipio": "municipio"}),
                     ["id_entidad", "id_municipio"], ["municipio"], name="tc_municipio")
    df = left_enrich(df, _catalog(bundle["edad"], ["id_edad"], {"desc_edad": "edad_descripcion"}),
                     ["id_edad"], ["edad_descripcion"], name="tc_edad")

    present = set(df.columns)
    cleaned = {c: clean_text(c).alias(c) for c in TEXT_COLUMNS if c in present}
    coerced = {c: coerce_int(c).alias(c) for c in NUMERIC_COLUMNS if c in present}
    missing = [c for c in NUMERIC_COLUMNS if c not in present]
    if missing:
        raise ValueError(f"incident file lacks numeric columns {missing}")
    df = df.select(*[cleaned.get(c, coerced.get(c, F.col(c))) for c in df.columns])

    full = parse_date("anio", "mes", "id_dia")
    df = df.select("*", full.alias("full_date"), date_key(full).alias("date_key"),
                   time_key("id_hora", "id_minuto").alias("time_key"))
    return with_digests(df, {name: list(renames) for name, (_, _, renames) in DIMENSIONS.items()})


def numbered_base(staged: DataFrame) -> DataFrame:
    """The written base with ``source_row_id``, its 1-based position in the file."""
    missing = [c for c in TAGS if c not in staged.columns]
    if missing:
        raise ValueError(f"the base lacks its scan position {missing}")
    return number_rows_in_file(staged, "source_row_id")


def base_gates() -> dict[str, Column]:
    """V13, V12 (measures) and the NOT NULL location ids: what rejects a load, measured as the base is written."""
    return {
        "invalid_dates": F.coalesce(~F.col("full_date").between(*[F.lit(d).cast("date") for d in DATE_RANGE]), F.lit(True)),
        "null_location_ids": F.col("id_entidad").isNull() | F.col("id_municipio").isNull(),
        "measures_out_of_range": (F.greatest(*MEASURE_SOURCE) > SMALLINT_MAX) | (F.least(*MEASURE_SOURCE) < SMALLINT_MIN)}


def pass_gates(found: dict[str, int]) -> None:
    """Raise when any date is invalid (the whole load is rejected, as in the
    source system), a location id is missing (the stored column is NOT NULL) or
    a measure does not fit SMALLINT."""
    if found["invalid_dates"]:
        raise ValueError(f"{found['invalid_dates']} records have an invalid date; load rejected")
    if found["null_location_ids"]:
        raise ValueError(f"{found['null_location_ids']} records lack an entity or municipality id; "
                         "load rejected")
    if found.get("dates_outside_the_range"):
        raise ValueError(f"{found['dates_outside_the_range']} records lie outside the dates to replace; load rejected")
    if found["measures_out_of_range"]:
        raise ValueError(f"measure range check failed: fact_accidentes.smallint:measures="
                         f"{found['measures_out_of_range']}")


def build_members(base: DataFrame, published: dict[str, DataFrame] | None = None,
                  num_partitions: int | None = None) -> dict[str, Members]:
    """The members of the three derived dimensions, by the base's column names.

    One grouping-sets aggregate over the base yields the distinct rows of all
    three.  Members of the ``published`` dimensions keep their keys; only
    absent ones are numbered, above them.
    """
    specs = {name: (list(renames), key) for name, (key, _, renames) in DIMENSIONS.items()}
    known = {name: published[name].select(key, *[F.col(t).alias(s) for s, t in renames.items()])
             for name, (key, _, renames) in DIMENSIONS.items()} if published else None
    return number_members(base, specs, known=known, num_partitions=num_partitions)


def dimension_tables(members: dict[str, Members]) -> dict[str, DataFrame]:
    """The members with the columns of their tables."""
    return {name: members[name].frame.withColumnsRenamed(renames) for name, (_, _, renames) in DIMENSIONS.items()}


def resolve_keys(base: DataFrame, members: dict[str, Members]) -> DataFrame:
    """Replace natural keys by surrogate keys; 32 fact columns, typed.

    Casting to SMALLINT happens under ANSI mode, so a measure that does not
    fit raises instead of wrapping (as the typed warehouse column would).
    """
    fact = lookup_members(base, members)
    renames = {**VEHICLE_COLUMNS, **PERSON_COLUMNS}
    fact = fact.select("*", F.col("source_row_id").alias("accidente_id"),
                       F.lit(1).alias("num_accidentes"))
    return conform(fact.withColumnsRenamed(renames), FACT_ACCIDENTES)

"""Load, validate and publish the incident warehouse.

Layout under ``target``: ``_runs/<run_id>/<table>`` holds what one load wrote,
and ``_published`` is a log of versions.  A version is a manifest: the run whose
dimensions hold, and for the fact a list of date ranges, each with the run that
holds its rows.  A load replaces the whole fact or one range of dates; the other
ranges stay where they are, by reference.  A run writes each of its tables once
(lineage is cut there: a lost executor recomputes from files, not from the raw
CSV), validates them, and only then publishes the next version, which succeeds
only if the version it started from is still the latest.  The cleaned base is
deleted when the run ends, and so is the whole run when it fails; nothing else
is copied, and a failed run is never visible.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..commits import CommitLog
from ..constants import BAND_ORDER, TEXT_LIMITS
from ..operators import quality as Q
from ..schemas import STAR_SCHEMAS, conform
from ..sources.csv import extract
from ..sources.warehouse import read_jdbc, read_table, table_path
from ..staging import delete_path, stage
from .calendar import date_dim, insert_if_absent, time_dim
from .star import (DIMENSIONS, FACT_MEASURES, base_gates, build_base, build_members, dimension_tables,
                   numbered_base, pass_gates, resolve_keys)

STAR_TABLES = ["dim_fecha", "dim_tiempo", "dim_ubicacion", "dim_accidente", "dim_conductor",
               "fact_accidentes"]
VEHICLE_MEASURES = FACT_MEASURES[1:14]
CASUALTY_MEASURES = FACT_MEASURES[14:]


# ---------------------------------------------------------------- sinks

def write_table(df: DataFrame, root: str, name: str, mode: str = "overwrite") -> str:
    """Parquet sink; ``append`` adds files, ``overwrite`` resets."""
    path = table_path(root, name)
    df.write.mode(mode).parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batchsize: int = 10_000, truncate: bool = False,
               properties: dict | None = None) -> None:
    """S4-S6 against an external database: batched inserts; ``truncate`` keeps
    the table definition on overwrite (reset without dropping constraints)."""
    props = dict(properties or {})
    props["batchsize"] = str(batchsize)
    if truncate:
        props["truncate"] = "true"
    df.write.jdbc(url, table, mode=mode, properties=props)


CELLS = 64                      # stretches of row ids that a date is counted in


def date_layout(base: DataFrame, files: int, last_id: int) -> DataFrame:
    """(date_key, cell, part): which of ``files`` files takes the rows of a date and a stretch of row ids.

    The bounds come from a count per date and stretch, which merges on the map
    side: every file gets about as many rows, whole cells in the order of date
    and id.  A date with many rows is spread over several files.  The running
    totals are over the dates, and within a date over its cells.
    """
    cells = base.groupBy("date_key", _cell(last_id).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    cells = stage(cells, "date-cells")
    days = cells.groupBy("date_key").agg(F.sum("n").alias("n"))
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(F.col("date_key").alias("day"), F.coalesce(F.sum("n").over(upto.orderBy("date_key")), F.lit(0)).alias("days_before"),
                       F.sum("n").over(Window.partitionBy()).alias("total"))
    within = F.coalesce(F.sum("n").over(upto.partitionBy("date_key").orderBy("cell")), F.lit(0))
    placed = cells.withColumn("within", within).join(days, F.col("date_key") == F.col("day"))
    middle = F.col("days_before") + F.col("within") + F.expr("n DIV 2")
    part = F.least(F.lit(files - 1), (middle * files / F.greatest("total", F.lit(1))).cast("int"))
    return stage(placed.select("date_key", "cell", part.alias("part")), "date-layout")


def _cell(last_id: int) -> Column:
    return F.expr(f"(source_row_id - 1) DIV {max(1, -(-last_id // CELLS))}")


def cluster_fact(fact: DataFrame, layout: DataFrame, files: int, last_id: int) -> DataFrame:
    """Lay the fact out by date so Parquet min/max statistics prune date scans.

    Rows are dealt by the explicit bounds of ``layout``, so the plan below them,
    key joins included, runs once; range partitioning would run it again for a
    sample.
    """
    bounds = layout.select(F.col("date_key").alias("of_date"), F.col("cell").alias("of_cell"), "part")
    cell = _cell(last_id)
    dealt = fact.join(bounds, (F.col("date_key") == F.col("of_date")) & (cell == F.col("of_cell")))
    dealt = dealt.repartitionById(files, "part").drop("of_date", "of_cell", "part")
    return dealt.sortWithinPartitions("date_key", "source_row_id")


def export_jdbc(tables: dict[str, DataFrame], url: str, properties: dict | None = None) -> None:
    """S4-S6, S12 against a database: reset and load the star, dimensions first.

    A thin use of Spark's JDBC sink, which this project's tests do not run:
    they start no database.
    """
    for name in STAR_TABLES:
        write_jdbc(tables[name], url, name, "overwrite", truncate=True, properties=properties)


def calendar_tables(spark: SparkSession, existing: dict[str, DataFrame], first: str,
                    last: str) -> dict[str, DataFrame]:
    """Date and time dimensions, merged insert-if-absent into the published ones."""
    out = {}
    for name, fresh, key in (("dim_fecha", date_dim(spark, first, last), "date_key"),
                             ("dim_tiempo", time_dim(spark), "time_key")):
        out[name] = insert_if_absent(existing[name], fresh, [key]) if name in existing else fresh
    return out


# ---------------------------------------------------------------- validation

def fact_rules() -> dict[str, Column]:
    """The row rules of the fact."""
    return {
        **Q.not_null_rules(STAR_SCHEMAS["fact_accidentes"].names),
        "equal:accidente_id=source_row_id": F.col("accidente_id") != F.col("source_row_id"),
        "const:num_accidentes": F.col("num_accidentes") != 1,
        "nonneg:vehicles": F.least(*VEHICLE_MEASURES) < 0,
        "nonneg:casualties": F.least(*CASUALTY_MEASURES) < 0}


PK_RULE = "pk+unique:source_row_id"


def validation_report(t: dict[str, DataFrame], of_fact: list[DataFrame] | None = None) -> DataFrame:
    """Every integrity rule of the star as (rule, table_name, violations).

    ``of_fact``: reports that stand for the fact's row rules and primary key,
    where a load has measured them already.
    """
    parts = []
    fecha, tiempo, fact = t["dim_fecha"], t["dim_tiempo"], t["fact_accidentes"]

    def lengths(name):
        return {f"length:{c}": F.length(c) > n for c, n in TEXT_LIMITS.get(name, {}).items()}

    parts += [
        Q.table_rules(fecha, "dim_fecha", {
            **Q.not_null_rules(fecha.columns),
            "range:trimestre": ~F.col("trimestre").between(1, 4),
            "range:mes_numero": ~F.col("mes_numero").between(1, 12),
            "range:dia_mes": ~F.col("dia_mes").between(1, 31),
            "range:dia_semana_numero": ~F.col("dia_semana_numero").between(1, 7),
            **lengths("dim_fecha")}, {"pk": ["date_key"], "unique:full_date": ["full_date"]}),
        Q.table_rules(tiempo, "dim_tiempo", {
            **Q.not_null_rules(tiempo.columns),
            "range:hora": ~F.col("hora").between(-1, 23),
            "range:minuto": ~F.col("minuto").between(-1, 59),
            "domain:banda_horaria": ~F.col("banda_horaria").isin(*BAND_ORDER),
            **lengths("dim_tiempo")}, {"pk": ["time_key"], "unique:hora_texto": ["hora_texto"]}),
    ]
    natural_unique = {"dim_ubicacion": ["id_entidad", "id_municipio", "cobertura"],
                      "dim_accidente": DIMENSIONS["dim_accidente"][1],
                      "dim_conductor": DIMENSIONS["dim_conductor"][1]}
    for name, (key, _, _) in DIMENSIONS.items():
        parts.append(Q.table_rules(t[name], name, {**Q.not_null_rules(t[name].columns), **lengths(name)},
                                   {"pk": [key], "unique:natural": natural_unique[name]}))
    ubic = t["dim_ubicacion"]
    parts += [
        Q.dependency_rule(ubic, "dim_ubicacion", "fd:ids_coverage->names",
                          ["id_entidad", "id_municipio", "cobertura"], ["entidad", "municipio"]),
        Q.foreign_key_rules(fact, "fact_accidentes", [(fk, t[dim_name], fk, f"fk:{fk}") for fk, dim_name in (
            ("date_key", "dim_fecha"), ("time_key", "dim_tiempo"),
            ("ubicacion_key", "dim_ubicacion"), ("accidente_key", "dim_accidente"),
            ("conductor_key", "dim_conductor"))]),
    ]
    # accidente_id is the source row id by construction (a row rule checks it),
    # so one uniqueness rule of one BIGINT column proves both constraints.
    parts += of_fact or [Q.unique_rule(fact, "fact_accidentes", PK_RULE, ["accidente_id"]),
                         Q.row_rules(fact, "fact_accidentes", fact_rules())]
    return Q.report(parts)


SUMMARY = {"total_muertos": "total_muertos", "total_heridos": "total_heridos", "total_automoviles": "automovil",
           "total_motocicletas": "motocicleta", "total_bicicletas": "bicicleta"}


def load_summary(fact: DataFrame) -> DataFrame:
    """Count and headline sums of a fact."""
    return fact.agg(F.count(F.lit(1)).alias("total_accidentes"), *[F.sum(c).alias(n) for n, c in SUMMARY.items()])


# ---------------------------------------------------------------- the load

PUBLISHED = "_published"


def run_path(target: str, run_id: str) -> str:
    return f"{str(target).rstrip('/')}/_runs/{run_id}"


def published(spark: SparkSession, target: str) -> CommitLog:
    return CommitLog(spark, table_path(target, PUBLISHED))


def current_run(spark: SparkSession, target: str) -> str | None:
    """Run id of the latest published load (None before the first one).

    Only an absent log means that; a log that cannot be read is an error.
    """
    entry = published(spark, target).head()[1]
    return entry["run_id"] if entry else None


def replaced(parts: list[dict], lo: int, hi: int) -> list[dict]:
    """The date ranges of a manifest without ``lo`` to ``hi``: a range that reaches beyond on a side keeps that side."""
    out = []
    for p in parts:
        if p["lo"] < lo:
            out.append({**p, "hi": min(p["hi"], lo - 1)})
        if p["hi"] > hi:
            out.append({**p, "lo": max(p["lo"], hi + 1)})
    return out


def run_load(spark: SparkSession, data_dir: str, target: str, first: str = "2024-01-01",
             last: str = "2024-12-31", run_id: str | None = None, num_partitions: int | None = None,
             multiline: bool = False, replace: tuple[str, str] | None = None) -> dict:
    """Extract -> base -> dimensions -> fact -> validate -> publish.

    Every table of the run is written once under ``target/_runs/<run_id>/``
    and read back from there (lineage cut on shared storage).  Nothing is
    copied: after every rule passes, the run's manifest becomes the next
    published version, which is the atomic switch readers follow.  If another
    load published since this one began, it fails with ``Conflict`` and leaves
    nothing; run it again.  ``multiline`` reads line breaks inside quoted cells.

    ``first`` and ``last`` bound the calendar.  Without ``replace`` the files
    are the whole fact.  With it, they are the rows of these dates (both
    included; another date rejects the load): published rows of other dates
    stay, unread and unwritten, and new rows are numbered above all that were
    published.  Published members and calendar days stay in the dimensions with
    their keys.

    The rows that must arrive are counted in the file itself, before anything
    is done to them (A15/V15).  Row counts, gates, NULL keys, constants, signs
    and the summary are measured by the writes themselves; neither the base nor
    the fact is read again for them.
    """
    run_id = run_id or uuid.uuid4().hex
    run = run_path(target, run_id)
    log = published(spark, target)
    parent, entry = log.head()
    try:
        staged, seen, bounds = _build_run(spark, data_dir, run, entry and read_star(spark, target, version=parent), first, last,
                                          num_partitions, multiline, replace, entry["last_id"] if entry and replace else 0)
        delete_path(spark, table_path(run, "_base"))
        lo, hi = bounds if replace else (0, 99991231)
        part = {"run_id": run_id, "lo": lo, "hi": hi}
        kept = replaced(entry["fact"], lo, hi) if entry and replace else []
        last_id = seen.rows + (entry["last_id"] if entry and replace else 0)
        version = log.commit(parent, {"run_id": run_id, "parent": parent, "fact": [*kept, part], "last_id": last_id})
    except Exception as exc:
        delete_path(spark, run)
        if isinstance(exc, PySparkException) and (found := re.search(r"\w+: key \[[^]]*\] is not unique", str(exc))):
            raise ValueError(found[0]) from exc
        raise
    return {"run_id": run_id, "version": version, "rows": seen.rows, "tables": staged,
            "summary": {"total_accidentes": seen.rows, **seen.sums}}


def _build_run(spark: SparkSession, data_dir: str, run: str, existing: dict[str, DataFrame] | None,
               first: str, last: str, num_partitions: int | None, multiline: bool,
               replace: tuple[str, str] | None, id_offset: int) -> tuple[dict[str, DataFrame], Q.WriteMetrics, tuple[int, int]]:
    bundle = extract(spark, data_dir, multiline)
    bounds = tuple(int(d.replace("-", "")) for d in replace or (first, last))
    gates = base_gates()
    if replace:
        gates["dates_outside_the_range"] = ~F.col("date_key").between(*bounds)
    gate = Q.WriteMetrics(build_base(bundle), "base", gates)
    write_table(gate.watched, run, "_base")
    pass_gates(gate.violations)
    base = numbered_base(read_table(spark, run, "_base"))

    staged: dict[str, DataFrame] = {}
    for name, df in calendar_tables(spark, existing or {}, first, last).items():
        write_table(conform(df, STAR_SCHEMAS[name]), run, name)
        staged[name] = read_table(spark, run, name)
    members = build_members(base, existing, num_partitions)
    for name, df in dimension_tables(members).items():
        write_table(conform(df, STAR_SCHEMAS[name]), run, name)
        staged[name] = read_table(spark, run, name)

    files = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    layout = date_layout(base, files, gate.rows)
    fact = cluster_fact(resolve_keys(base, members), layout, files, gate.rows)
    if id_offset:
        fact = conform(fact.withColumns({c: F.col(c) + id_offset for c in ("source_row_id", "accidente_id")}), STAR_SCHEMAS["fact_accidentes"])
    seen = Q.WriteMetrics(fact, "fact_accidentes", fact_rules(), SUMMARY)
    write_table(seen.watched, run, "fact_accidentes")
    staged["fact_accidentes"] = read_table(spark, run, "fact_accidentes")

    rows = bundle["atus"].count()
    for what, n in (("base", gate.rows), ("fact_accidentes", seen.rows)):
        Q.expect_count(n, rows, what)
    # Every base row is in the fact at least once (left joins) and there are as many fact rows:
    # the fact's ids are unique if the base's are, and those stand in file order.
    unique = Q.dense_unique_rule(base, "fact_accidentes", PK_RULE, "source_row_id")
    Q.enforce(validation_report(staged, [unique, seen.report(spark)]), "post-load")
    return staged, seen, bounds


def retain(spark: SparkSession, target: str, versions: int = 2) -> list[str]:
    """Keep the latest ``versions`` versions; delete older log entries and the runs that no kept version needs.

    Frames of older versions that were handed out stop reading.  A run that is
    being loaded is not in the log yet: call this when no load is under way.
    Returns the deleted run ids.
    """
    log = published(spark, target)
    found = log.versions()
    entries = {v: log.read(v) for v in found}
    kept = found[-max(1, versions):]
    needed = {r for v in kept for r in (entries[v]["run_id"], *(p["run_id"] for p in entries[v]["fact"]))}
    old = {r for e in entries.values() for r in (e["run_id"], *(p["run_id"] for p in e["fact"]))} - needed
    for v in found:
        if v not in kept:
            log.forget(v)
    for run_id in old:
        delete_path(spark, run_path(target, run_id))
    return sorted(old)


def fact_parts(spark: SparkSession, target: str, entry: dict) -> dict[str, DataFrame]:
    """The published fact by date range: one frame per range of the manifest, named after its run and dates."""
    out = {}
    for p in sorted(entry["fact"], key=lambda p: p["lo"]):
        df = read_table(spark, run_path(target, p["run_id"]), "fact_accidentes")
        whole = p["lo"] <= 0 and p["hi"] >= 99991231
        out[f"{p['run_id']}-{p['lo']}-{p['hi']}"] = df if whole else df.filter(F.col("date_key").between(p["lo"], p["hi"]))
    return out


def read_star(spark: SparkSession, target: str, jdbc_url: str | None = None,
              properties: dict | None = None, version: int | None = None) -> dict[str, DataFrame]:
    """S3: the published tables (latest version unless ``version``), or a JDBC database."""
    if jdbc_url:
        return {n: read_jdbc(spark, jdbc_url, n, properties) for n in STAR_TABLES}
    log = published(spark, target)
    entry = log.read(version) if version else log.head()[1]
    if entry is None:
        raise FileNotFoundError(f"no published load under {target}")
    out = {n: read_table(spark, run_path(target, entry["run_id"]), n) for n in STAR_TABLES[:-1]}
    return {**out, "fact_accidentes": reduce(DataFrame.unionByName, fact_parts(spark, target, entry).values())}


def register_views(spark: SparkSession, target: str, version: int | None = None) -> dict[str, DataFrame]:
    """Expose the published star as temporary views named like its tables.

    Lets the analytical SQL run unchanged in ``spark.sql`` (dialect-only
    syntax such as ``::NUMERIC`` aside); Catalyst plans it exactly like the
    DataFrame reports.
    """
    tables = read_star(spark, target, version=version)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables

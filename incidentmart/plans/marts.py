"""Result marts (S13, R12): reports written once and re-read while fresh.

The dashboard of the reproduced system re-ran each query at most every ten
minutes.  Here a report is written as a Parquet mart under a shared folder; a
reader within ``ttl_seconds`` of its computation gets the stored rows, anyone
later recomputes them.  Every computation is a folder of its own, and a log
(:class:`~incidentmart.commits.CommitLog`) says which one holds, so a frame that
was handed out reads on undisturbed until its folder is pruned.

A mart of sums need not be recomputed when part of the fact changes: it is kept
as partial sums per part of the fact (date ranges of a published star), and a
refresh computes the partial sums of new parts only.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..commits import CommitLog, Conflict
from ..sources.warehouse import table_path
from ..staging import delete_path

DEFAULT_TTL_SECONDS = 600
KEEP = 4                        # versions of a mart that stay readable


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _publish(log: CommitLog, entry: dict) -> dict:
    """Make ``entry`` the mart's next version, whoever else publishes; versions beyond the last ``KEEP`` go."""
    while True:
        try:
            log.commit(log.head()[0], entry)
            break
        except Conflict:
            continue
    found = log.versions()
    kept = {path for v in found[-KEEP:] for path in log.read(v)["folders"].values()}
    for v in found[:-KEEP]:
        for path in set(log.read(v)["folders"].values()) - kept:
            delete_path(log.spark, path)
        log.forget(v)
    return entry


def _log(spark: SparkSession, root: str, name: str) -> CommitLog:
    return CommitLog(spark, f"{table_path(root, name)}/_versions")


def write_mart(df: DataFrame, root: str, name: str) -> str:
    """Write a new version of the mart and make it current."""
    path = f"{table_path(root, name)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _publish(_log(df.sparkSession, root, name), {"folders": {"rows": path}, "computed_at": _now().isoformat()})
    return path


def read_mart(spark: SparkSession, root: str, name: str,
              ttl_seconds: int = DEFAULT_TTL_SECONDS) -> DataFrame | None:
    """The stored report when it is younger than ``ttl_seconds``, else None."""
    entry = _log(spark, root, name).head()[1]
    if entry is None or (_now() - dt.datetime.fromisoformat(entry["computed_at"])).total_seconds() > ttl_seconds:
        return None
    return spark.read.parquet(entry["folders"]["rows"])


def report_mart(spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame],
                ttl_seconds: int = DEFAULT_TTL_SECONDS) -> DataFrame:
    """Fresh stored rows if any, otherwise ``build()`` written and read back."""
    fresh = read_mart(spark, root, name, ttl_seconds)
    if fresh is not None:
        return fresh
    return spark.read.parquet(write_mart(build(), root, name))


def sum_mart(spark: SparkSession, root: str, name: str, parts: dict[str, DataFrame],
             groups: list[str], measures: dict[str, str]) -> DataFrame:
    """``SUM`` of ``measures`` (name -> column) by ``groups`` over all ``parts``, kept up by merging.

    ``parts`` names the parts of a fact whose rows never change under that name,
    as :func:`~incidentmart.plans.load.fact_parts` gives them.  Partial sums of
    a part that the current version has are reused unread; those of new parts
    are computed and written, and a version that lists exactly the given parts
    becomes current.  The result sums the partial sums, one row per part and
    group at most.  A sum over NULLs only is NULL, as it would be over the rows.
    Other groups or measures under the same name start from nothing.
    """
    log = _log(spark, root, name)
    shape = hashlib.sha256(repr((groups, sorted(measures.items()))).encode()).hexdigest()[:16]
    entry = log.head()[1]
    have = entry["folders"] if entry and entry.get("shape") == shape else {}
    folders = {}
    for part, rows in parts.items():
        if part not in have:
            path = f"{table_path(root, name)}/{uuid.uuid4().hex}"
            rows.groupBy(*groups).agg(*[F.sum(c).alias(n) for n, c in measures.items()]).write.parquet(path)
            folders[part] = path
        else:
            folders[part] = have[part]
    if folders != have:
        _publish(log, {"folders": folders, "shape": shape, "computed_at": _now().isoformat()})
    partial = reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in folders.values()])
    return partial.groupBy(*groups).agg(*[F.sum(n).alias(n) for n in measures])

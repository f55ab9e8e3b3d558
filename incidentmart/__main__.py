"""Command line: load a yearly file set, or print a report of the published star.

    python -m incidentmart load --data-dir raw/ --target warehouse/
    python -m incidentmart report entity_ranking --target warehouse/
"""

from __future__ import annotations

import argparse
import sys

from .plans import reports as R
from .plans.load import read_star, run_load
from .session import get_spark

REPORTS = {
    "entity_ranking": lambda s, t: R.entity_ranking(t),
    "month_trend": lambda s, t: R.month_trend(t),
    "daily_moving_average": lambda s, t: R.daily_moving_average(t),
    "weekday_band_profile": lambda s, t: R.weekday_band_profile(t),
    "weekday_band_matrix": lambda s, t: R.weekday_band_matrix(s, t),
    "top_municipalities": lambda s, t: R.top_municipalities(t),
    "classification_share": lambda s, t: R.classification_share(t),
    "vehicle_ranking": lambda s, t: R.vehicle_ranking(t),
    "kpis": lambda s, t: R.kpis(t),
    "kpis_severity": lambda s, t: R.kpis_severity(t),
    "driver_profile_with_victims": lambda s, t: R.driver_profile_with_victims(t),
    "top_entities_check": lambda s, t: R.top_entities_check(t),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="incidentmart")
    parser.add_argument("--master", default=None, help="Spark master (default: as configured)")
    sub = parser.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="extract, build, validate and publish the star")
    load.add_argument("--data-dir", required=True)
    load.add_argument("--target", required=True)
    load.add_argument("--first", default="2024-01-01")
    load.add_argument("--last", default="2024-12-31")
    load.add_argument("--multiline", action="store_true", help="cells may hold line breaks")
    rep = sub.add_parser("report", help="print one report of the published star")
    rep.add_argument("name", choices=sorted(REPORTS))
    rep.add_argument("--target", required=True)
    rep.add_argument("--rows", type=int, default=50)
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None   # only stop a session we start
    spark = get_spark(args.master)
    try:
        if args.cmd == "load":
            res = run_load(spark, args.data_dir, args.target, args.first, args.last,
                           multiline=args.multiline)
            print(f"run {res['run_id']}: {res['rows']:,} rows published")
            print(res["summary"])
            R.top_entities_check(res["tables"]).show(truncate=False)
        else:
            REPORTS[args.name](spark, read_star(spark, args.target)).show(args.rows, truncate=False)
    except Exception as exc:  # noqa: BLE001 - report and fail like a batch job
        print(f"failed: {exc}", file=sys.stderr)
        return 1
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

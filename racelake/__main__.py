"""Command line: build or refresh the layers, show a report.

    python -m racelake refresh LANDING_ROOT OUT_ROOT [--min-athletes N]
    python -m racelake build-from-tables TABLES_DIR OUT_ROOT [--min-athletes N]
    python -m racelake report OUT_ROOT NAME [--rows N]

``refresh`` ingests new CSV files of a landing root (main feed in the root,
``second_feed/`` and ``country_codes/`` sub-folders) through bronze and
silver incrementally and recomputes gold. ``report`` runs one of the report
queries over written layers and prints its rows.
"""

from __future__ import annotations

import argparse

from racelake.plans import profile as P
from racelake.plans import reports as R

REPORTS = {
    "athletes_by_country": lambda t: R.athletes_by_country(t["gold/mart_distance_events"]),
    "gender_share": lambda t: R.gender_share(t["gold/mart_distance_events"]),
    "events_by_year": lambda t: R.events_by_year(t["gold/mart_distance_events"]),
    "max_finishers": lambda t: R.max_finishers(t["gold/mart_overview"]),
    "speed_by_gender": lambda t: R.speed_by_gender(t["gold/mart_distance_events"]),
    "popular_events": lambda t: R.popular_events(t["gold/mart_overview"]),
    "finisher_sum": lambda t: R.finisher_sum(t["gold/mart_distance_events"]),
    "kpis": lambda t: R.kpis(t["gold/mart_overview"]),
    "growth": lambda t: R.growth(t["gold/mart_overview"]),
    "top_countries": lambda t: R.top_countries(t["gold/mart_overview"]),
    "metric_coverage": lambda t: R.metric_coverage(t["gold/fct_results"]),
    "speed_by_country": lambda t: R.speed_by_country(t["gold/fct_results"], t["gold/dim_athlete"]),
    "null_counts": lambda t: P.null_counts(t["bronze/raw_results"]),
}
TABLES = ["bronze/raw_results", "bronze/second_feed", "bronze/country_codes", "silver/results",
          "gold/fct_results", "gold/dim_event", "gold/dim_athlete", "gold/dim_date",
          "gold/mart_distance_events", "gold/mart_time_events", "gold/mart_overview"]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="racelake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("landing_root")
    r.add_argument("out_root")
    r.add_argument("--min-athletes", type=int, default=100)
    b = sub.add_parser("build-from-tables")
    b.add_argument("tables_dir")
    b.add_argument("out_root")
    b.add_argument("--min-athletes", type=int, default=100)
    q = sub.add_parser("report")
    q.add_argument("out_root")
    q.add_argument("name", choices=sorted(REPORTS))
    q.add_argument("--rows", type=int, default=50)
    args = ap.parse_args(argv)

    from racelake.plans.layers import build_layers, refresh_layers
    from racelake.session import get_spark

    spark = get_spark()
    if args.cmd == "refresh":
        t = refresh_layers(spark, args.landing_root, args.out_root, args.min_athletes)
        print({k: v.count() for k, v in t.items()})
    elif args.cmd == "build-from-tables":
        t = build_layers(spark, args.tables_dir, args.out_root, args.min_athletes)
        print({k: v.count() for k, v in t.items()})
    else:
        root = args.out_root.rstrip("/")
        t = {name: spark.read.parquet(f"{root}/{name}") for name in TABLES}
        REPORTS[args.name](t).show(args.rows, truncate=False)


if __name__ == "__main__":
    main()

"""Write the physical plans of the headline queries to docs/PLANS.md.

    python tools/show_plans.py [sf_dir]

Plans are taken over written layers (the production path). They are the
plans AQE starts from; its runtime changes (coalesced partitions, late
broadcasts, skew splits) are decided per run and are not shown. Only the operator tree and the lines that matter for
scale (scan filters and schemas, exchanges, join types) are kept.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

KEEP = re.compile(r"^(\(\d+\) \S|PushedFilters|ReadSchema|Arguments: (hash|single|rangepart)|Join type|Keys)")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    tree = tree.replace("== Physical Plan ==\n", "")
    kept = [ln[:200] for ln in details.splitlines() if KEEP.match(ln)]
    return tree.strip() + "\n\n" + "\n".join(kept)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from racelake.session import get_spark, scratch_path
    from racelake.plans import gold as G
    from racelake.plans import profile as P
    from racelake.plans import reports as R
    from racelake.plans import silver as S
    from racelake.plans.layers import build_layers

    spark = get_spark(master="local[8]", shuffle_partitions=16,
                      extra_conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plans-ckpt-"))
    t = build_layers(spark, sf_dir, scratch_path(spark, "plans"))
    combined = S.combine_feeds(t["bronze/raw_results"], t["bronze/second_feed"])
    silver = t["silver/results"]
    fact, ev, ath, dt = (t[f"gold/{n}"] for n in ("fct_results", "dim_event", "dim_athlete", "dim_date"))
    plans = {
        "silver: cleaning chain + lookup join (bronze -> silver)":
            S.clean_results(combined, t["bronze/country_codes"]),
        "dim_athlete (silver -> gold)": G.dim_athlete(silver),
        "dim_date (silver -> gold)": G.dim_date(silver),
        "mart_distance_events (written fact + dimensions)": G.mart_distance_events(fact, ev, ath),
        "mart_overview (written fact + dimensions)": G.mart_overview(fact, ev, ath, dt),
        "Q1 athletes by country (distance mart)": R.athletes_by_country(t["gold/mart_distance_events"]),
        "Q2 gender share (distance mart)": R.gender_share(t["gold/mart_distance_events"]),
        "C7 country / year slice": R.country_year_slice(fact, ath, ev, "NATION_7", 1995, 2020),
        "profile: distinct counts (bronze)": P.distinct_counts(t["bronze/raw_results"]),
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/show_plans.py` on `{os.path.basename(sf_dir)}` with local[8] and",
           "16 shuffle partitions, over the written layers. These are the plans AQE starts",
           "from: tables whose files are below the broadcast threshold are broadcast at this",
           "scale; at cluster scale the same joins stay sort-merge joins, which AQE may still",
           "turn into broadcasts or split for skew at run time.", ""]
    for title, df in plans.items():
        out += [f"## {title}", "", "```", _plan(df), "```", ""]
    os.makedirs(os.path.join(HERE, "docs"), exist_ok=True)
    with open(os.path.join(HERE, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)

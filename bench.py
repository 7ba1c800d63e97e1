"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of local cores and ``BENCH_QUERIES`` an optional
comma-separated choice of queries. Every query is computed in full and its rows are discarded; the time of a query
is the better of two runs, so that start-up and code generation do not hide the work.
"""

from __future__ import annotations

import json
import os
import time

from basinspark.catalog import QUERIES, load_all
from basinspark.session import local_session

HEADLINE = [
    "ensemble_summary",
    "model_mean",
    "grand_mean",
    "model_median",
    "quantile_band",
    "large_group_quantiles",
    "pivot_features",
    "unpivot_predictions",
    "wide_by_lead",
    "lag_lead_features",
    "lag_large_series",
    "area_lookup_cms",
    "zonal_weighted_mean",
    "regrid_bilinear",
    "grid_to_run_table",
    "obs_left_join",
    "obs_outer_join",
    "table_compare",
    "keyed_upsert",
    "latest_by_key",
    "link_harvest",
    "skill_raw",
    "skill_own",
    "skill_groups",
    "crps_members",
    "crps_large_ensembles",
    "plot_feed",
    "verification_flow",
    "published_forecast",
    "linear_fit_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = local_session("bench", cores, spark__sql__shuffle__partitions=cores, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of the better of two runs each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
            }
        )
    )


if __name__ == "__main__":
    main()

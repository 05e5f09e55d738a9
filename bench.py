"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` data folder, ``BENCH_CPUS`` local cores, ``BENCH_QUERIES``
comma-separated names or ``all``. Every result row is computed (noop sink).
Each query derives its stand-in tables from the raw single-file tables itself.
``BENCH_PREPARE=1`` writes the larger ones once in several files, as a loaded lake
holds them; that time is reported as ``prepare_sec`` and is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from surelake import session
from surelake.plans import catalog, views

HEADLINE = (
    "valid_policy_count regulation_times_monthly months_streak job_type_top1 job_type_max_paid insured_persons insured_rate "
    "claim_rate report_delay_avg payout_expected risk_level_pivot frequent_removals channel_ratio person_claims person_payout "
    "premium_daily premium_policy_day premium_policy_to_date premium_slope daily_headcount headcount_ent_day member_tier alerts_surge "
    "merge_insured merge_endorse recon_match plan_matrix product_flags_by_mobile profile_person ride_behaviour web_action_names "
    "claim_nearest_policy shared_people name_similarity qa_topk payout_estimate log_error_groups graph_k_hop "
    "stream_profile_state stream_crm_upsert"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    prepared = None
    qs = catalog.queries()
    names = list(qs) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = session.build(
        f"local[{cpus}]", "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()  # start-up is not part of a query
    start = time.perf_counter()
    if os.environ.get("BENCH_PREPARE", "0") != "0":
        prepared = session.scratch(spark, "bench")
        views.prepare(spark, folder, prepared, int(cpus))
        qs = catalog.queries(prepared)
    prepare_sec = round(time.perf_counter() - start, 3)
    print(f"prepare {prepare_sec}", file=sys.stderr, flush=True)
    times: dict[str, float] = {}
    for name in names:
        t = time.perf_counter()
        qs[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "prepare_sec": prepare_sec, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

Each query runs once unmeasured (class loading, code generation) and is then timed;
the result is computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import time

from pulseboard.plans.catalog import QUERIES
from pulseboard.session import build_session

HEADLINE = [
    "agg1_hourly_pv_uv", "agg5_clicks_by_user_and_type", "agg7_day_total", "agg8_rolling_sum", "agg10_window_members",
    "win1_running_distinct", "win1_running_users_by_label", "win2_running_max", "win4_global_rank",
    "top1_two_phase", "top2_room_topn", "st4_tumbling_window", "st5_sliding_window",
    "cep1_sequence", "mut1_apply_changes", "jn1_lookup", "jn6_composite_key_lookup",
    "f17_salted_row_key", "f18_geohash", "f30_json_decode", "srch1_fuzzy_search", "src13_scroll_pages",
    "snk3_keyed_upsert", "snk4_additive_upsert", "snk12_event_time_folders", "snk13_partition_commit",
    "agg1_hourly_pv_uv_stream", "top2_room_topn_stream", "cep1_sequence_stream", "snk4_additive_upsert_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for measured in (False, True):
            began = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            if measured:
                seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()

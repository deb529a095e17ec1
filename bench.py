"""Times the headline queries and prints one JSON line.

Input is ``$BENCH_SF_DIR`` (default sf0.1), the session ``local[$BENCH_CPUS]``. Each query
is built and run to the end into a sink that discards rows; the better of
``$BENCH_RUNS`` (default 2) runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tellerscope.plans import catalog  # noqa: E402
from tellerscope.session import build_session  # noqa: E402

HEADLINE = (
    "silver_transactions",
    "gold_transactions",
    "gold_unmatched",
    "fraud_amount_by_country",
    "country_flow_top20",
    "fraud_type_breakdown",
    "fraud_over_time",
    "large_flows_rounded",
    "numeric_profile",
    "type_frequencies",
    "country_pairs_top80",
    "type_stats",
    "risk_features",
    "risk_scores",
    "risk_explanation",
    "explain_transaction_risk",
    "cdc_current_state",
    "cdc_row_counts",
    "live_metrics",
    "live_country_flows",
    "live_time_buckets",
    "parse_json_messages",
    "insert_if_absent",
    "merge_insert_only",
    "gold_impact",
    "evaluate",
    "train_rf",
    "score_batch",
    "stream_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {}
    queries["table_count"](spark, sf_dir).collect()  # starts the engine
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from vigilpay.plans.catalog import QUERIES
from vigilpay.session import drop_staged, local_session

HEADLINE = [
    "parse_transactions", "dead_letter", "dedup_event_id", "route_late", "on_time_events",
    "r001_user_frequency", "r002_user_amount", "r003_device_users", "r004_card_users",
    "r005_consecutive_failure", "r006_black_device", "r007_user_amount_spike", "r008_merchant_spike",
    "risk_alerts", "metric_transaction_count_1m", "metric_channel_success_rate_5m",
    "metric_merchant_amount_5m", "realtime_metrics", "q_top_users_by_alerts",
    "time_series_equal_bins", "risk_scatter", "channel_label_heatmap", "map_aml_to_transaction",
    "convert_metadata",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    # the first query pays for starting the JVM and compiling common code
    QUERIES["r001_user_frequency"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    drop_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from millrace.plans.queries import QUERIES

HEADLINE = [
    "page_query_params",
    "base64_json_documents",
    "schema_violations",
    "sql_over_events",
    "page_view_events",
    "tracker_contexts",
    "all_or_nothing_payloads",
    "dead_letters",
    "geo_events",
    "shred_all_schemas",
    "order_payloads",
    "payload_size_split",
    "avro_round_trip",
    "event_json_round_trip",
    "stream_enrichment",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

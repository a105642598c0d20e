"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the test tables, ``BENCH_CPUS`` the number of local cores.
Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. A run builds the
plan anew and writes all result columns to Spark's ``noop`` sink. The stream runs once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from playledger.session import SETTINGS  # noqa: E402
from playledger.testbed.queries import QUERIES  # noqa: E402

HEADLINE = (
    "recap_top_songs",
    "recap_top_albums",
    "recap_top_artists",
    "recap_forgotten_songs",
    "recap_top_songs_events",
    "recap_forgotten_songs_events",
    "recap_suite",
    "join_fact_song",
    "join_fact_album",
    "join_fact_artist",
    "minutes_by_song",
    "last_played_days",
    "unresolved_facts",
    "explode_plays",
    "flatten_album",
    "parse_album_topic",
    "parse_item_topic",
    "new_keys_album",
    "enrich_new_keys",
    "route_topics",
    "reply_fields",
    "report_final",
)
ONCE = ("stream_dispatch", "pipeline_roundtrip")


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = SETTINGS | {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
    for name in HEADLINE:
        times[name] = round(
            statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3
        )
    for name in ONCE:
        times[name] = round(seconds(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

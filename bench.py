"""Headline queries on the bench data; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clicktide import catalog  # noqa: E402
from clicktide.session import build_session, clear_scratch  # noqa: E402

HEADLINE = (
    "event_counts",
    "partition_round_trip",
    "clean_behavior",
    "funnel",
    "suspect_users",
    "sessionize",
    "sessionize_global",
    "hourly_activity",
    "quality_report",
    "hysteresis",
    "backlog",
    "stratified_split",
    "word_frequency",
    "sub_category_stats",
    "review_page",
    "char_tfidf",
    "extract_features",
    "route_dead_letters",
    "window_counts",
    "stream_sessions",
    "sample_n",
    "online_zscore",
    "impute_median",
    "buy_model_scores",
    "ablation",
    "storage_report",
)
#: Every query runs once to warm up, then RUNS times; beyond MAX_SECONDS in all, once only.
RUNS, MAX_SECONDS = 3, 900


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    catalog.load_all()
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # starts the executors
    seconds, first, started = {}, {}, time.perf_counter()

    def timed(name: str) -> float:
        begun = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    for name in HEADLINE:
        first[name] = round(timed(name), 3)
        times = []
        while len(times) < RUNS and (not times or time.perf_counter() - started < MAX_SECONDS):
            times.append(timed(name))
        seconds[name] = round(median(times), 3)
        clear_scratch(spark)

    def per_second(table: str, query: str) -> float:
        return round(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / seconds[query], 1)

    result = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "first_runs": first,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "rates": {
            "events_scored_per_sec": per_second("events", "route_dead_letters"),
            "log_rows_cleaned_per_sec": per_second("events", "clean_behavior"),
            "texts_extracted_per_sec": per_second("documents", "extract_features"),
        },
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

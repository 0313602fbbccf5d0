"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_RUNS (timed runs per query after one warm-up, default 3),
BENCH_QUERIES (comma list, default the headline queries; ``all`` for every
registered query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry.queries import QUERIES, reference, silver  # noqa: E402
from trendlake import build_session, category_analytics, channel_analytics, trending_analytics  # noqa: E402

HEADLINE = (
    "scan_region_pruned", "payload_flatten", "null_fill_and_ratios", "clean_statistics", "dedup_latest",
    "clean_reference", "stats_with_category", "trending_analytics", "channel_analytics", "category_analytics",
    "region_targeting", "category_momentum", "channel_partners_top15", "channel_top10_region",
    "publish_timing", "quality_report", "ingestion_coverage", "file_classification",
)


def run_once(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def gold_from_silver(spark, sf_dir: str, runs: int) -> dict[str, float]:
    """Gold tables alone, from silver that is stored once: what each costs without cleansing."""
    with tempfile.TemporaryDirectory(prefix="bench-silver-") as folder:
        silver(spark, sf_dir).write.parquet(f"{folder}/statistics")
        reference(spark, sf_dir).write.parquet(f"{folder}/reference")
        stats, names = (spark.read.parquet(f"{folder}/{name}") for name in ("statistics", "reference"))
        tables = {
            "gold_trending": lambda *_: trending_analytics(stats),
            "gold_channel": lambda *_: channel_analytics(stats, names),
            "gold_category": lambda *_: category_analytics(stats, names),
        }
        seconds = {}
        for name, build in tables.items():
            run_once(build, spark, sf_dir)
            seconds[name] = round(statistics.median(run_once(build, spark, sf_dir) for _ in range(runs)), 3)
            print(f"{seconds[name]:8.3f}s {name}", file=sys.stderr, flush=True)
        return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run_once(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run_once(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{seconds[name]:8.3f}s {name}", file=sys.stderr, flush=True)
    if not chosen:
        seconds.update(gold_from_silver(spark, sf_dir, runs))
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(seconds[name] for name in names), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()

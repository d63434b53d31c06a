"""Headline-query timings.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query once to warm up (on ``BENCH_WARMUP_DIR``, default the
sf0.01 tables: same code paths, a fraction of the time), then ``BENCH_RUNS``
times (default 3) on ``BENCH_SF_DIR``, and reports the median seconds per query. Each run builds the query and
materialises it completely through the ``noop`` sink (no collect). Prints one
JSON line. ``BENCH_EVENT_LOG_DIR`` (optional) writes Spark's event log there for
stage and task timings.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "liquidity_metrics",
    "liquidity_metrics_salted_kll",
    "liquidity_rank",
    "otc_pairing",
    "sliding_window_agg",
    "sliding_window_plain",
    "sliding_window_preagg",
    "latest_quote",
    "snapshot_explode",
    "enriched_quotes_batch",
    "stream_sliding_window",
    "stream_enriched_quotes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from liqspark.session import build_session
    from liqspark.plans import catalog

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        os.makedirs(os.environ["BENCH_EVENT_LOG_DIR"], exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus), extra=extra)
    variants = dict(catalog.queries())
    variants.update(catalog.bench_variants())

    def once(name: str, data_dir: str = sf_dir) -> float:
        t0 = time.perf_counter()
        df = variants[name](spark, data_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # All queries once for warm-up (JIT, code paths, native libraries), then in turns, so
    # none is always the first.
    for name in names:
        once(name, warm_dir)
    taken: dict[str, list[float]] = {name: [] for name in names}
    for turn in range(runs):
        for name in names[turn % len(names):] + names[:turn % len(names)]:
            taken[name].append(once(name))
    timings = {name: round(statistics.median(t), 3) for name, t in taken.items()}

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query runs once to warm up and then three times; the median is reported. A run executes the
whole plan into the ``noop`` sink (no collect, no output files), so the time is the job itself.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from vigil.plans.catalog import REGISTRY  # noqa: E402
from vigil.session import get_session  # noqa: E402
from vigil.sources.tables import Inputs  # noqa: E402

HEADLINE = [
    "fact_unified",             # whole outbreak ETL (anti-join, counter, repair self-join, lookups, union)
    "repair_negatives",         # 7-day self-join repair
    "day_counter_first_seen",   # first-seen day counter
    "topk_series",              # SQL aggregate -> top-5 -> their series
    "top_bigrams",              # tokens -> stop words -> bigrams -> counts -> top 20
    "top_trigrams",
    "sentiment_scores",         # lexicon scoring per post
    "sentiment_rules",          # lexicon scoring with the positional rules
    "posts_mart",               # posts job (search, clean, score with rules)
    "forecast_top_countries",   # 15 series x (trend, weekly effect, band) + 60-day spine
    "ols_chart_data",           # per-country regressions and fitted values
]
RUNS = 3


def run_once(inp: Inputs, name: str) -> float:
    t0 = time.perf_counter()
    df = REGISTRY[name].build(inp)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = argv or HEADLINE
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="vigil-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    inp = Inputs(spark, sf_dir)
    results: dict[str, float] = {}
    for name in names:
        run_once(inp, name)  # warm-up
        times = [run_once(inp, name) for _ in range(RUNS)]
        results[name] = round(statistics.median(times), 3)
        print(f"# {name}: {results[name]:.3f}s (runs {[round(t, 2) for t in times]})", file=sys.stderr)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus, "runs": RUNS}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

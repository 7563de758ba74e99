"""Headline-query benchmark.

Runs the registered headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
Each query is executed in full with the ``noop`` sink (no collect to the
driver); the session is first warmed on the sf0.01 tables (JIT of the regex,
aggregation and join paths) so the recorded times are steady-state.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordloom.plans import catalog  # noqa: E402
from wordloom.session import local_session  # noqa: E402

HEADLINE = [
    "ngram_counts",
    "ngram_top1",
    "ngram_predict",
    "ngram_generate",
    "bpe_train",
    "bpe_tokenize",
    "qa_requests",
    "grade_requests",
    "qa_accuracy_by_model",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    # Warm the JVM (JIT of the regex, aggregation and join paths) on the
    # smallest tables so the timings below are steady-state query times.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm) and warm != sf_dir:
        for w in ("ngram_predict", "bpe_train", "qa_requests"):
            catalog.REGISTRY[w](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()

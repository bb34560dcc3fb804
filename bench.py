"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected) and timed on its own. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edgefilter.plans import registry  # noqa: E402
from edgefilter.session import get_session  # noqa: E402

HEADLINE = [
    "edits_clean",
    "avg_user_edits_weighted",
    "user_day_edits_join",
    "feature_correlation",
    "word_counts_human",
    "top_words_bot",
    "bloom_build",
    "bloom_semi_join",
    "bloom_evaluation",
    "exact_knn",
    "lsh_bucket_topk",
    "lsh_grid",
    "hashed_tf",
    "idf_weights",
    "classification_metrics",
    "train_bot_model",
    "normalize_change_events",
    "stream_blacklist_growth",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = registry.queries()[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * int(cpus)),
                        extra={"spark.driver.memory": "16g"})
    run(spark, "avg_length_by_bot", sf_dir)          # warm-up: JVM, codegen, file listing
    times = {}
    for name in names:
        times[name] = round(run(spark, name, sf_dir), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

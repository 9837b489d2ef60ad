"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built (fits included) and executed to completion with a no-op
sink (no result is collected to the driver). One warm-up pass, then the median
of $BENCH_RUNS timed runs per query. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kiln.plans.catalog import load_all  # noqa: E402
from kiln.session import build_session  # noqa: E402

HEADLINE = [
    "conditional_rate", "fill_median", "fill_mode", "one_hot", "label_encode", "skewness", "correlation_matrix",
    "histogram_compare", "boxplot_by", "kde_curve", "zscore_filter", "log_skewed", "standard_scale",
    "dedup_text", "stratified_folds", "row_id", "discounted_returns", "trailing_mean", "td_target",
    "metric_auc", "metric_medae", "word_counts", "ngram_counts", "tfidf", "clf_multinomial_nb",
    "clf_knn", "clf_gaussian_nb", "reg_linear", "reg_knn",
]
# Iterative families: timed once, cold.
ONCE = ["bpe_train", "bpe_encode", "clf_svm", "reg_svr"]


def run_once(spark, fn, sf: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE + ONCE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="kiln-bench")
    reg = load_all()
    times = {}
    for name in names:
        fn = reg[name].fn
        if name in ONCE:
            times[name] = round(run_once(spark, fn, sf), 3)
        else:
            run_once(spark, fn, sf)  # warm-up: JIT, codegen, file listing
            times[name] = round(statistics.median(run_once(spark, fn, sf) for _ in range(runs)), 3)
        spark.catalog.clearCache()
    sf_label = os.path.basename(sf.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_label, "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

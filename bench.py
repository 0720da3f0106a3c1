"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print ONE JSON line {"metric", "value", "unit", "queries", "sf"}.

Every query is executed completely (Spark's ``noop`` sink materialises all
rows without collecting them to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "eval_shuffle_cv",        # flagship: 1000 stratified splits, GNB refit per split
    "eval_smote_gnb",         # the reference's final setup: borderline SMOTE + 1000-split GNB
    "clf_gaussian_nb",
    "split_strat_kfold",
    "outlier_rows_iqr",
    "corr_spearman",
    "interaction_features",
    "drop_nonfinite_columns",
    "agg_describe",
    "join_knn",
    "smote_borderline",
    "clf_knn",
    "tfidf",
    "text_features",
    "str_split_ws",
    "text_stem_join",
    "oversample_duplicate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # one JVM is driver and executor here
    os.environ.setdefault("RAREMINE_DRIVER_MEMORY", "12g")
    from raremine.plans import catalog
    from raremine.session import get_session

    spark = get_session(f"local[{cpus}]", app="raremine-bench", shuffle_partitions=max(8, 2 * cpus))
    names = only or HEADLINE
    # warm-up (JVM, Python workers, Parquet footers) outside the timings
    catalog.QUERIES["agg_shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in names:
        t0 = time.time()
        try:
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as exc:            # keep the one-line contract even if a query fails
            times[name] = None
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    out = {"metric": "total_query_seconds", "value": round(sum(v for v in times.values() if v), 3),
           "unit": "sec", "queries": times, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()

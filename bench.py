"""Headline-query bench.

Runs the flagship and headline queries at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints ONE JSON line.
Each query is executed in full through the no-op sink (every row computed,
nothing collected).  The one-off derivation of the basket tables from the
TPC-H-like test tables is reported as ``ingest_sec`` and not counted in
``value``: real input arrives as basket tables.  Model queries are timed under
``models`` and not counted in ``value`` either, which stays comparable.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_table", "feature_table_notebook", "holdout_train", "holdout_test",
    "holdout_subset", "holdout_subset_prior", "user_features", "product_features",
    "user_product_features", "dept_bins", "aisle_bins", "best_f1", "auc",
    "fold_summary", "eda_dept_freq", "eda_aisle_top_bottom",
]

MODELS = ["gbt_scores", "gbt_staged_scores", "lr_l1_grid", "cv_gbt"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    from rebuy.session import JOB_CONF
    b = (SparkSession.builder.master(f"local[{cpus}]").appName("rebuy-bench")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus))))
         .config("spark.driver.memory", "16g"))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from rebuy.plans.queries import REGISTRY, tables
    t0 = time.time()
    tables(spark, sf_dir)
    ingest = time.time() - t0

    def timed(names: list[str]) -> dict[str, float]:
        out = {}
        for name in names:
            t0 = time.time()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[name] = round(time.time() - t0, 3)
        return out
    times, models = timed(HEADLINE), timed(MODELS)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "models": models, "ingest_sec": round(ingest, 3),
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

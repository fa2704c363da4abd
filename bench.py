"""Times the headline queries on BENCH_SF_DIR with local[BENCH_CPUS] and prints one JSON line."""

import json
import os
import time

from vintagewise.catalog import QUERIES
from vintagewise.session import build_session

HEADLINE = [
    "clean_loans", "clean_financials", "label_store", "bad_rate_by_month", "trailing_window_agg", "feature_store",
    "label_coverage", "match_indicator", "null_profile", "quantile_edges", "hist_shares", "decile_bad_rate",
    "pearson_matrix", "spearman_matrix", "psi_numeric", "drift_rows", "score_psi", "psi_prev_period", "auc_gini",
    "auc_overall", "roc_grid", "feature_gini", "cohort_performance", "latest_run", "monitoring_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="20g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

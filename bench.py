"""Headline queries, timed: prints one JSON line. Each query runs once to warm up and then counts its best of two runs."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wickwork.operators import vif as V
from wickwork.plans import catalogue
from wickwork.session import SETTINGS, ship

HEADLINE = (
    "candles_1h", "range_bounded", "dedupe_keep_last", "ffill_impute", "sparsity_report", "synthetic_ohlc", "ind_bbands", "ind_cci",
    "ind_rsi", "ind_macd", "ind_adx", "ind_rsi_6h_synthetic", "ind_batch", "vif_matrix_k3", "pipeline_features_vif", "store_upsert",
)


def normal(spark, rows: int, columns: int):
    return spark.range(rows).select(*(F.randn(42 + i).alias(f"x{i}") for i in range(columns)))


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    own = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": cpus}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=SETTINGS | own).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)

    def timed(run) -> float:
        best = None
        for k in range(3):
            t = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            t = time.perf_counter() - t
            best = best if k == 0 else min(t, best or t)
        return round(best, 3)

    found = {name: timed(lambda f=catalogue.QUERIES[name]: f(spark, sf_dir)) for name in HEADLINE}
    for method, rows, columns in (("matrix", 5_000, 50), ("parallel", 5_000, 50), ("streaming", 100_000, 20)):
        found[f"vif_{method}_{rows}x{columns}"] = timed(lambda m=method, r=rows, c=columns: V.vif(normal(spark, r, c), m))
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(found.values()), 3), "unit": "sec", "queries": found, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

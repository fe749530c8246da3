"""Time two operators beside their plain forms and print one JSON line.

Plain imputation: one window over the whole table, as one task, with a frame
that reaches to the end. Plain cross-validation: ``ntile`` over the whole
table, then a fit and an evaluation per fold. BENCH_SF_DIR and BENCH_CPUS as
for ``bench.py``.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bench import session
from tablaris.operators.impute import filled_value, impute
from tablaris.operators.regression import cross_validate, evaluate, fit, predict
from workload.queries import FEATURES, LABEL, LINE_KEY, charges, table


def orders_with_holes(spark: SparkSession, data: str) -> DataFrame:
    key = F.col("o_orderkey")
    total = F.when(key % 7 != 0, F.col("o_totalprice")).alias("total")
    return table(spark, data, "orders").select(key, total)


def plain_impute(df: DataFrame) -> DataFrame:
    whole = Window.partitionBy(F.lit(1)).orderBy("o_orderkey")
    upto = whole.rowsBetween(Window.unboundedPreceding, 0)
    onward = whole.rowsBetween(0, Window.unboundedFollowing)
    seen = df.select(
        "*",
        F.last("total", ignorenulls=True).over(upto).alias("_prev_total"),
        F.first("total", ignorenulls=True).over(onward).alias("_next_total"),
    )
    return seen.select("o_orderkey", filled_value("total", None).alias("total"))


def plain_cross_validate(df: DataFrame) -> list[float]:
    folded = df.withColumn("fold", F.ntile(5).over(Window.orderBy(*LINE_KEY)))
    scores = []
    for fold in range(1, 6):
        model = fit(folded.where(F.col("fold") != fold), FEATURES, LABEL)
        test = predict(folded.where(F.col("fold") == fold), model)
        scores.append(evaluate(test, LABEL).first()["r2"])
    return scores


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count())))
    orders, lines = orders_with_holes(spark, data), charges(spark, data)
    sliced = max(10_000, orders.count() // 8)
    runs = {
        "impute": lambda: drain(impute(orders, ["total"], ["o_orderkey"])),
        "impute_sliced": lambda: drain(
            impute(orders, ["total"], ["o_orderkey"], window_rows=sliced)
        ),
        "impute_plain": lambda: drain(plain_impute(orders)),
        "cross_validate": lambda: cross_validate(lines, FEATURES, LABEL, LINE_KEY),
        "cross_validate_plain": lambda: plain_cross_validate(lines),
    }
    times = {}
    for name, work in runs.items():
        first = seconds(work)
        times[name] = first if first > 30 else min(first, seconds(work))
    print(json.dumps({"seconds": times, "data": data}))
    spark.stop()


if __name__ == "__main__":
    main()

"""spark-submit tablaris/jobs/train.py --input clean --features a,b --label y --keys k ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tablaris.plans.train import train
from tablaris.sources.models import save_models
from tablaris.sources.staging import staged_run
from tablaris.sources.tables import write_parquet


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Fit a linear model on a Parquet table")
    parser.add_argument("--input", required=True)
    parser.add_argument("--features", required=True)
    parser.add_argument("--label", required=True)
    parser.add_argument("--keys", required=True, help="columns that identify a row")
    parser.add_argument("--order", help="row order of the folds, default the keys")
    parser.add_argument("--name", default="model")
    parser.add_argument("--display", default="", help="what answers call the model")
    parser.add_argument("--model-out", required=True)
    parser.add_argument("--summary-out", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    with staged_run(spark):
        report = train(
            spark.read.parquet(args.input),
            args.features.split(","),
            args.label,
            args.keys.split(","),
            args.order.split(",") if args.order else None,
            args.name,
            display=args.display,
        )
        save_models(spark, [report.model], args.model_out)
        write_parquet(report.summary(spark).coalesce(1), args.summary_out)


if __name__ == "__main__":
    main()

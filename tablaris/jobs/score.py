"""spark-submit tablaris/jobs/score.py --requests r --models m --output o"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tablaris.plans.presets import EXERCISES, MESSAGES
from tablaris.plans.score import score_with_stored_models
from tablaris.sources.tables import write_parquet


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Answer a Parquet table of scoring requests")
    parser.add_argument("--requests", required=True)
    parser.add_argument("--models", required=True)
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    requests = spark.read.parquet(args.requests)
    answers = score_with_stored_models(spark, requests, args.models, EXERCISES, MESSAGES)
    write_parquet(answers, args.output)


if __name__ == "__main__":
    main()

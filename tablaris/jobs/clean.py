"""spark-submit tablaris/jobs/clean.py --preset dolar --input in.csv --output out --report rep"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tablaris.plans.clean import clean_csv
from tablaris.plans.presets import SPECS
from tablaris.sources.staging import staged_run


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Clean a CSV table")
    parser.add_argument("--preset", choices=sorted(SPECS), required=True)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--report", required=True)
    parser.add_argument("--single-csv", action="store_true")
    parser.add_argument("--quantiles", choices=["exact", "approx"], default="exact")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    with staged_run(spark):
        clean_csv(
            spark,
            args.input,
            args.output,
            args.report,
            SPECS[args.preset],
            args.single_csv,
            args.quantiles,
        )


if __name__ == "__main__":
    main()

"""Historical run: all trip files to daily KPIs in monthly Parquet partitions."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from farebox.plans.historical import run_historical, update_historical


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="glob of trip files")
    parser.add_argument("--output", required=True)
    parser.add_argument("--update", action="store_true", help="replace only the months that changed files can touch")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("farebox-historical").getOrCreate()
    (update_historical if args.update else run_historical)(spark, args.input, args.output)


if __name__ == "__main__":
    main()

"""Daily run: check the source, rebuild the marts, test them, print the day."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from farebox.plans.pipeline import PipelineConfig, run_for_date


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--run-date", required=True, help="yyyy-MM-dd")
    parser.add_argument("--trips-dir", required=True)
    parser.add_argument("--zones-csv", required=True)
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--clustered", action="store_true")
    parser.add_argument("--lenient", action="store_true", help="report failing checks, do not stop")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("farebox-daily").getOrCreate()
    conf = PipelineConfig(args.trips_dir, args.zones_csv, args.output_dir, clustered=args.clustered)
    result = run_for_date(spark, conf, args.run_date, strict=not args.lenient)
    for line in result.report:
        print(f"{'pass' if line.passed else 'FAIL'}  {line.relation}.{line.column}  {line.check}  {line.failures}")
    print(f"date {result.run_date}  trips {result.summary.total_trips}  revenue {result.summary.total_revenue}")


if __name__ == "__main__":
    main()

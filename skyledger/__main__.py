"""``spark-submit``/``python -m skyledger SOURCE STAGING TARGET [--load-date DATE]``."""

import argparse
from datetime import date

from pyspark.sql import SparkSession

from skyledger.plans import etl
from skyledger.session import settings


def main() -> None:
    parser = argparse.ArgumentParser(prog="skyledger", description=__doc__)
    parser.add_argument("source", help="folder with the CSV files")
    parser.add_argument("staging", help="folder for the staging tables")
    parser.add_argument("target", help="folder for the warehouse tables")
    parser.add_argument("--load-date", default=date.today().isoformat())
    parser.add_argument("--multi-line", action="store_true", help="quoted fields may hold line ends; a file is then one task")
    args = parser.parse_args()
    spark = settings(SparkSession.builder.appName("skyledger")).getOrCreate()
    etl.run(spark, args.source, args.staging, args.target, args.load_date, multi_line=args.multi_line).show(truncate=False)


if __name__ == "__main__":
    main()

"""The full run as a job: ``python -m loanbook`` or ``spark-submit``.

Takes ``customers.csv``, ``loans.csv`` and ``payments.csv`` from the input
folder and leaves the four result tables as CSV folders in the output folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from loanbook import Snapshot
from loanbook.plans import run


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="loanbook", description=__doc__)
    parser.add_argument("--input", required=True, help="folder with the three CSV files")
    parser.add_argument("--lake", required=True, help="folder for stored tables")
    parser.add_argument("--output", required=True, help="folder for CSV copies of the results")
    parser.add_argument("--ingestion-date", help="day of the raw rows, today if not given")
    parser.add_argument("--data-referencia", help="date of the indicators, today if not given")
    parser.add_argument("--data-corte", help="day arrears are measured on, today if not given")
    parser.add_argument("--fail-on-violation", action="store_true", help="stop if a declared check fails")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    options = arguments(given)
    spark = SparkSession.builder.appName("loanbook").getOrCreate()
    run.run(
        spark,
        options.input,
        options.lake,
        options.output,
        Snapshot(options.data_referencia, options.data_corte),
        options.ingestion_date,
        options.fail_on_violation,
    )


if __name__ == "__main__":
    main()

"""Times what is run in production over stored raw tables; prints one JSON line.

The raw credit tables are written once as date-partitioned Parquet. Cleaned
tables are timed from there; installments, loan table, indicators and the curve
from the tables the step before them stores; ``full_refresh`` is the whole run
with all its writes. Each figure is the median of three runs in a warm session.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanbook import contract as c
from loanbook.catalog.queries import SNAPSHOT
from loanbook.plans import adhoc, gold, run, silver
from loanbook.sources import bronze, driver_tables, tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("loanbook-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def store_raw(spark: SparkSession, lake: str) -> None:
    for table, make in driver_tables.RAW_TABLES.items():
        rows = make(spark, SF_DIR).repartition(int(CPUS))
        rows.write.partitionBy(c.INGESTION_COLUMN).parquet(f"{lake}/bronze/{table}")


def headline(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    raw = {table: bronze.read_bronze(spark, f"{lake}/bronze", table) for table in c.RAW_COLUMNS}
    made = {
        "stg_customers": silver.stg_customers(raw["customers"]),
        "stg_loans": silver.stg_loans(raw["loans"]),
        "stg_payments": silver.stg_payments(raw["payments"], SNAPSHOT),
    }
    customers, loans, payments, described = (
        tables.read_table(spark, f"{lake}/silver/{name}") for name in [*made, "loans_described"]
    )
    installments = tables.read_table(spark, f"{lake}/gold/mart_credit_installments")
    loan_mart = tables.read_table(spark, f"{lake}/gold/mart_credit_loans")
    return made | {
        "loans_described": gold.described_loans(loans, customers),
        "mart_credit_installments": gold.installments_of_described(described, payments, SNAPSHOT),
        "mart_credit_loans": gold.mart_credit_loans(gold.int_loan_performance(loans, installments, SNAPSHOT)),
        "mart_kpis_daily": gold.mart_kpis_daily(loan_mart, installments, SNAPSHOT),
        "mart_kpis_vintage": gold.mart_kpis_vintage(loan_mart, installments, SNAPSHOT),
        "par_ratios": adhoc.par_ratios(loan_mart),
    }


def timed(job: Callable[[], object]) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def last_row(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def median_of(job: Callable[[], object]) -> float:
    job()
    return round(statistics.median(timed(job) for _ in range(RUNS)), 3)


def main() -> None:
    spark = session()
    with tempfile.TemporaryDirectory(prefix="loanbook-bench-") as lake:
        stored = timed(lambda: store_raw(spark, lake))
        seconds = {"full_refresh": median_of(lambda: run.refresh(spark, lake, SNAPSHOT))}
        for name, rows in headline(spark, lake).items():
            seconds[name] = median_of(lambda rows=rows: last_row(rows))
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "store_raw_sec": round(stored, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from loanbook.functions.casting import safe_date, safe_double, safe_int

INTEGERS = {
    "12": 12, " 12 ": 12, "\t12": 12, "-3": -3, "+5": 5, "12.0": 12, "12.": 12, "12.5": 13, "-12.5": -13,
    ".5": 1, "0.4": 0, "1e1": 10, "1E2": 100, "1_000": 1000, "1__0": None, "_1": None, "1_": None, "abc": None,
    "": None, ".": None, "-": None, "1.5d": None, "2147483647": 2147483647, "2147483648": None, "1e10": None,
    "nan": None, "inf": None, "1,5": None, "1 2": None, None: None,
}
DOUBLES = {
    "1.5": 1.5, " 1.5 ": 1.5, "\n2": 2.0, "-1": -1.0, "+1.5": 1.5, ".5": 0.5, "5.": 5.0, "1e3": 1000.0,
    "1_000.5": 1000.5, "1.5_0": 1.5, "1._5": None, "1.5d": None, "1.5f": None, "1.5D": None, "1.5L": None,
    "0x1p3": None, "inf": math.inf, "-inf": -math.inf, "Infinity": math.inf, "infinit": None, "1e400": math.inf,
    "1e": None, "e1": None, "n/a": None, "1,5": None, "": None, "--1": None, None: None,
}
D = dt.date(2024, 1, 5)
DATES = {
    "2024-01-05": D, " 2024-01-05 ": D, "2024-1-5": D, "2024/01/05": D, "2024 01 05": D, "2024\\01\\05": D,
    "2024/01-05": None, "2024": None, "2024-01": None, "+2024-01-05": None, "20240105": None, "05/01/2024": None,
    "2024-02-30": None, "2024-13-01": None, "2024-01-05 abc": None, "2024-01-05 10": None,
    "2024-01-05 10:00": D, "2024-01-05 10:00:00": D, "2024-01-05T10:00:00.123": D, "2024-01-05T": None,
    "2024-01-05 10:00:00Z": D, "2024-01-05 10:00:00+02": D, "2024-01-05 10:00:00 UTC": D, "2024-01-05Z": None,
    "2024-01-05 25:00:00": None, "02024-01-05": D, "2024-01-051": None, "": None, "2024-0a-05": None, None: None,
}


@pytest.mark.parametrize(
    ("cast", "cases"), [(safe_int, INTEGERS), (safe_double, DOUBLES), (safe_date, DATES)]
)
def test_accepts_exactly_the_listed_forms(spark, cast, cases):
    rows = spark.createDataFrame([(text,) for text in cases], "text string")
    got = {row.text: row.value for row in rows.select("text", cast(F.col("text")).alias("value")).collect()}
    assert got == cases


def test_nan_is_a_number(spark):
    rows = spark.createDataFrame([("nan",), ("NaN",)], "text string")
    values = [row[0] for row in rows.select(safe_double(F.col("text"))).collect()]
    assert all(math.isnan(value) for value in values)

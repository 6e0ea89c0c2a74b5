"""Safe text-to-value casts: NULL on anything that is not a value.

Spark's own ``try_cast`` accepts a few forms it should not here (``1.5d``,
``0x1p3``, a bare year as a date) and misses some it should (``1_000``, ``12.0``
as an integer). Plain values go straight to ``try_cast``; only text of an unusual
shape pays for the full pattern, and text that fits no pattern is never tried:
a failed numeric cast raises and catches an exception inside Spark, which on dirty
columns costs more than all the rest. Each function names its text a few times
only, so that the generated code of a stage with many casts stays small enough
to be compiled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of numbers and dates.
DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"^\s*[+-]?(?:(?:{DIGITS})?(?:\.(?:{DIGITS})?)?(?:[eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"
PLAIN_NUMBER = r"^[+-]?\d+(?:\.\d*)?$"
PLAIN_INTEGER = r"^[+-]?\d{1,9}$"
PLAIN_DATE = r"^\d{4}-\d\d-\d\d$"
TIME_OF_DAY = r"[ T](?:[01]?\d|2[0-4]):[0-5]?\d(?::[0-5]?\d(?:\.\d*)?)?"
ZONE = r"(?:Z|UTC|[+-]\d{1,2}(?::?\d{2})?)"
DATE = rf"^\s*(\d{{4,5}})([-/ \\])(\d{{1,2}})\2(\d{{1,2}})(?:{TIME_OF_DAY}\s*{ZONE}?)?\s*$"
# A date, or else the whole text, with all groups empty.
DATE_OR_ANYTHING = rf"{DATE}|(?s:^.*$)"


def trimmed(column: str) -> Column:
    """The raw column as text without leading or trailing spaces."""
    return F.trim(F.col(column).cast("string"))


def _filled(text: Column, value: Column) -> Column:
    return F.when(F.length(text) > 0, value)


def safe_double(text: Column) -> Column:
    unusual = F.when(text.rlike(NUMBER), F.translate(text, "_", ""))
    number = F.when(text.rlike(PLAIN_NUMBER), text).otherwise(unusual)
    return _filled(text, number.try_cast("double"))


def safe_int(text: Column) -> Column:
    """Whole numbers as they are; decimals and exponents rounded half away from zero."""
    rounded = F.round(safe_double(text)).try_cast("int")
    return _filled(text, F.when(text.rlike(PLAIN_INTEGER), text.try_cast("int")).otherwise(rounded))


def safe_date(text: Column) -> Column:
    rebuilt = F.regexp_replace(text, DATE_OR_ANYTHING, "$1-$3-$4")
    date = F.when(text.rlike(PLAIN_DATE), text).otherwise(rebuilt)
    return _filled(text, date.try_cast("date"))

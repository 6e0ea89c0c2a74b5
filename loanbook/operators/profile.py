"""Column profiles of any table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.operators.quantiles import exact_quantiles
from loanbook.sources.tables import staged

QUARTILES = [0.25, 0.5, 0.75]
#: Hash buckets that bound how often a value can occur.
BUCKETS = 1 << 16


def _per_column(rows: DataFrame, columns: list[str], measure, value: str) -> DataFrame:
    """One aggregate per column in one pass, as rows (coluna, tipo, value)."""
    types = dict(rows.dtypes)
    counts = rows.agg(*[measure(F.col(name)).alias(name) for name in columns])
    entries = [
        F.struct(F.lit(name).alias("coluna"), F.lit(types[name]).alias("tipo"), F.col(name).alias(value))
        for name in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def column_info(rows: DataFrame) -> DataFrame:
    """Type and number of values of every column: (coluna, tipo, nao_nulos)."""
    return _per_column(rows, rows.columns, F.count, "nao_nulos")


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs of the columns: (coluna, nulos)."""
    counted = _per_column(rows, columns, lambda column: F.count_if(column.isNull()), "nulos")
    return counted.select("coluna", "nulos")


def head(rows: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order; each task keeps ``n`` rows at most."""
    return rows.orderBy(*[F.asc_nulls_last(key) for key in keys]).limit(n)


def tail(rows: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows in key order."""
    return rows.orderBy(*[F.desc_nulls_last(key) for key in keys]).limit(n)


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    """Every value of a column once, NULL included."""
    return rows.select(column).distinct()


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """Frequency of every value, most frequent first: (valor, frequencia)."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("valor"))
        .agg(F.count(F.lit(1)).alias("frequencia"))
        .orderBy(F.desc("frequencia"), "valor")
    )


def top_values(rows: DataFrame, column: str, n: int, buckets: int = BUCKETS) -> DataFrame:
    """The first ``n`` rows of ``value_counts``, for columns of very many values.

    Rows are counted per hash bucket, which shuffles a bounded number of counts a
    task. A value occurs at most as often as its bucket, so once the values of
    the ``n`` fullest buckets are counted, buckets with fewer rows than the n-th
    of those values cannot hold any of the first ``n``; values of the others are
    counted in full. Where all values are about equally frequent that is every
    value, as in ``value_counts``: the result is exact in each case. NULL is no
    value; an empty column gives no rows.
    """
    # zeros of either sign are one value and must meet in one bucket
    same = F.col(column) + F.lit(0.0) if dict(rows.dtypes)[column] in ("double", "float") else F.col(column)
    values = rows.select(F.col(column).alias("valor"), F.pmod(F.xxhash64(same), F.lit(buckets)).alias("_bucket"))
    values = values.where("valor is not null")
    # one row a bucket, so never more of them than buckets
    filled = staged(values.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")), "filled-buckets")

    def counted(chosen: DataFrame) -> DataFrame:
        within = values.join(F.broadcast(chosen.select("_bucket")), "_bucket", "left_semi")
        counts = within.groupBy("valor").agg(F.count(F.lit(1)).alias("frequencia"))
        return counts.orderBy(F.desc("frequencia"), "valor").limit(n)

    fullest = filled.orderBy(F.desc("_rows"), "_bucket").limit(n)
    reached, least = counted(fullest).agg(F.count(F.lit(1)), F.min("frequencia")).first()
    return counted(filled.where(F.col("_rows") >= (least if reached == n else 0)))


def _number(name: str) -> Column:
    """A numeric column as double, with NaN as a missing value."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def describe(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of
    numeric columns: one row per column."""
    # several passes follow, so the few columns they read are stored once
    numbers = staged(rows.select([_number(name).alias(name) for name in columns]), "numbers")
    quartiles = exact_quantiles(numbers, columns, QUARTILES)
    measured = numbers.agg(
        *[
            F.struct(
                F.lit(name).alias("coluna"),
                F.count(name).alias("contagem"),
                F.avg(name).alias("media"),
                F.stddev_samp(name).alias("desvio"),
                F.min(name).alias("minimo"),
                *[
                    F.lit(value).cast("double").alias(label)
                    for label, value in zip(["q25", "q50", "q75"], quartiles[name])
                ],
                F.max(name).alias("maximo"),
            ).alias(name)
            for name in columns
        ]
    )
    return measured.select(F.inline(F.array(*[F.col(name) for name in columns])))


def labelled(profiles: dict[str, DataFrame]) -> DataFrame:
    """Profiles of several tables under one another, with the table's name."""
    parts = [
        profile.select(F.lit(name).alias("tabela"), *profile.columns)
        for name, profile in profiles.items()
    ]
    return reduce(DataFrame.unionByName, parts)

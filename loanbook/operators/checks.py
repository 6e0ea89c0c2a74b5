"""Declared column checks and flag counts, as tables of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook import contract as c


class CheckFailed(AssertionError):
    """Some declared check found violations."""


def _long_counts(counts: DataFrame, columns: list[str], label: str, value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(name).alias(label), F.col(name).alias(value)) for name in columns])
    return counts.select(F.inline(pairs))


def count_flags(rows: DataFrame, flags: list[str]) -> DataFrame:
    """How many rows carry each flag, in one pass: (flag, linhas)."""
    counts = rows.agg(*[F.count_if(F.col(name)).alias(name) for name in flags])
    return _long_counts(counts, flags, "flag", "linhas")


def count_nulls(rows: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column in one pass: (coluna, violacoes)."""
    counts = rows.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return _long_counts(counts, columns, "coluna", "violacoes")


def repeated_keys(rows: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("linhas"))
        .where(F.col("linhas") > 1)
    )


def _labelled(rows: DataFrame, table: str, check: str) -> DataFrame:
    return rows.select(
        F.lit(table).alias("tabela"), "coluna", F.lit(check).alias("teste"), "violacoes"
    )


def check_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of every declared not-null column of the given tables."""
    results = [
        _labelled(count_nulls(tables[name], columns), name, "not_null")
        for name, columns in c.NOT_NULL.items()
        if name in tables
    ]
    return _stacked(results)


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated keys of every declared unique column of the given tables."""
    results = [
        _labelled(
            repeated_keys(tables[name], column).agg(
                F.lit(column).alias("coluna"), F.count(F.lit(1)).alias("violacoes")
            ),
            name,
            "unique",
        )
        for name, columns in c.UNIQUE.items()
        for column in columns
        if name in tables
    ]
    return _stacked(results)


def repeated_installments(installments: DataFrame) -> DataFrame:
    """Installments that stand in more than one row, by their declared grain."""
    grain = ["loan_id", "numero_parcela", "data_vencimento"]
    return (
        installments.groupBy(grain).agg(F.count(F.lit(1)).alias("linhas")).where(F.col("linhas") > 1)
    )


def _stacked(results: list[DataFrame]) -> DataFrame:
    stacked = results[0]
    for result in results[1:]:
        stacked = stacked.unionByName(result)
    return stacked


def require_passed(results: DataFrame) -> None:
    """Raise if any of the check results (one row per declared check) failed."""
    failed = results.where(F.col("violacoes") > 0).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.tabela}.{r.coluna} {r.teste}: {r.violacoes}" for r in failed))

"""Per-loan results of the installments, and customer recurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.functions import credit
from loanbook.operators.joins import lookup


#: What is read of an installment.
TOTALLED_COLUMNS = [
    "loan_id",
    "data_vencimento",
    "data_corte",
    "valor_em_aberto",
    "dpd_efetivo",
    "dq_parcela_sem_registro_pagamento",
]


def loan_totals(installments: DataFrame, *more: Column) -> DataFrame:
    """One row per loan: current arrears, open balance and lateness marks, and
    any further aggregates."""
    overdue = (F.col("valor_em_aberto") > 0) & (F.col("data_vencimento") < F.col("data_corte"))
    dpd = F.col("dpd_efetivo")
    return installments.groupBy("loan_id").agg(
        F.max(F.when(overdue, dpd).otherwise(0)).alias("dpd_atual"),
        F.sum("valor_em_aberto").alias("saldo_em_aberto_aprox"),
        F.count_if("dq_parcela_sem_registro_pagamento").alias("parcelas_sem_registro"),
        F.max((dpd >= 30).cast("int")).alias("ever_30"),
        F.max((dpd >= 90).cast("int")).alias("ever_90"),
        *more,
    )


def status_from_totals() -> Column:
    return credit.derived_status(F.col("saldo_em_aberto_aprox"), F.col("dpd_atual"))


#: What is read of a loan.
LOAN_COLUMNS = [
    "loan_id",
    "customer_id",
    "data_concessao",
    "valor_contratado",
    "prazo_meses",
    "taxa_juros_anual",
    "status_reportado",
]
RECURRENCE = ["qtd_contratos_cliente", "cliente_recorrente"]


def loan_performance(
    loans: DataFrame, installments: DataFrame, cut: Column, carried: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """Every loan with its totals, derived status and whether that contradicts
    the reported one. Loans without a schedule keep NULL totals."""
    return (
        loans.select(*LOAN_COLUMNS, *carried)
        .join(loan_totals(installments), "loan_id", "left")
        .withColumn("data_corte", cut)
        .withColumn("status_derivado", status_from_totals())
        .withColumn(
            "dq_status_divergente",
            credit.flag(F.lower("status_reportado") != F.col("status_derivado")),
        )
    )


def customer_contracts(loans: DataFrame) -> DataFrame:
    """Number of contracts per customer; the NULL customer is one group."""
    contracts = F.count(F.lit(1))
    return loans.groupBy("customer_id").agg(
        contracts.alias("qtd_contratos_cliente"), (contracts > 1).alias("cliente_recorrente")
    )


def with_recurrence(performance: DataFrame) -> DataFrame:
    """Loans with their customer's contract count; none for a NULL customer."""
    joined = lookup(performance, customer_contracts(performance), "customer_id")
    return joined.select(*performance.columns, *RECURRENCE)

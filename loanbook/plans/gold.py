"""Installment and loan tables and the two indicator tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.operators import history, kpis, performance, schedule, vintage
from loanbook.operators.joins import lookup
from loanbook.snapshot import Snapshot

INSTALLMENT_LOAN_COLUMNS = [
    "data_concessao",
    "valor_contratado",
    "prazo_meses",
    "taxa_juros_anual",
    "canal",
    "status_reportado",
    "pmt_teorica",
]
CUSTOMER_COLUMNS = [
    "nome",
    "data_nascimento",
    "renda_mensal",
    "score_interno",
    "estado",
    "data_cadastro",
]
INSTALLMENT_COLUMNS = [
    "loan_id",
    "customer_id",
    "numero_parcela",
    "data_vencimento",
    "data_pagamento",
    "valor_devido",
    "valor_pago",
    "valor_em_aberto",
    "status_parcela",
    "dpd_efetivo",
    "data_corte",
]


def int_installments(loans: DataFrame, payments: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Scheduled installments with payments, amounts, status and DPD."""
    scheduled = loans.select(schedule.SCHEDULE_COLUMNS[:-2])
    return schedule.installments(scheduled, payments, snapshot.cut).select(
        *schedule.SCHEDULE_COLUMNS,
        *schedule.PAYMENT_COLUMNS,
        "valor_devido",
        "valor_pago",
        "valor_em_aberto",
        "status_parcela",
        "data_corte",
        "dpd_efetivo",
    )


def described_loans(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Loans with the attributes the installment table shows, their customer's included."""
    per_loan = loans.select("loan_id", "customer_id", *INSTALLMENT_LOAN_COLUMNS)
    return lookup(per_loan, customers.select("customer_id", *CUSTOMER_COLUMNS), "customer_id")


def installments_of_described(described: DataFrame, payments: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The installment table from described loans.

    The attributes travel with the loan into the match, so the installments, an
    order of magnitude more rows, are never shuffled for them. An installment
    without a loan key finds no loan.
    """
    known = F.col("loan_id").isNotNull()
    rows = schedule.installments(described, payments, snapshot.cut)
    return rows.select(
        *INSTALLMENT_COLUMNS,
        *[F.when(known, F.col(name)).alias(name) for name in INSTALLMENT_LOAN_COLUMNS],
        *CUSTOMER_COLUMNS,
        "dq_parcela_sem_registro_pagamento",
    )


def mart_credit_installments(
    loans: DataFrame, payments: DataFrame, customers: DataFrame, snapshot: Snapshot
) -> DataFrame:
    """Installments with the attributes of their loan and customer."""
    return installments_of_described(described_loans(loans, customers), payments, snapshot)


def int_loan_performance(loans: DataFrame, installments: DataFrame, snapshot: Snapshot) -> DataFrame:
    return performance.loan_performance(loans, installments, snapshot.cut)


def mart_credit_loans(loan_performance: DataFrame) -> DataFrame:
    return performance.with_recurrence(loan_performance)


def credit_loans(loans: DataFrame, installments: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The rows of ``mart_credit_loans`` where the performance table is not stored.

    Each loan is one row of that table, so contracts are counted on the loans and
    looked up before these meet their totals: the rows shuffled by customer are
    then narrower by what the totals hold.
    """
    counted = performance.with_recurrence(loans.select(performance.LOAN_COLUMNS))
    rows = performance.loan_performance(counted, installments, snapshot.cut, performance.RECURRENCE)
    others = [name for name in rows.columns if name not in performance.RECURRENCE]
    return rows.select(*others, *performance.RECURRENCE)


def mart_kpis_daily(loans: DataFrame, installments: DataFrame, snapshot: Snapshot) -> DataFrame:
    return kpis.daily_kpis(loans, installments, snapshot.reference)


def kpis_backfill(loans: DataFrame, typed_payments: DataFrame, dates: list[dt.date]) -> DataFrame:
    """The rows of ``mart_kpis_daily`` as of many dates, in one pass."""
    return history.daily_kpis_of_dates(loans, typed_payments, dates)


def portfolio_kpis(loans: DataFrame, installments: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The rows of ``mart_kpis_daily`` where the two marts are not stored."""
    return kpis.daily_kpis_in_one_pass(loans, installments, snapshot.reference)


def mart_kpis_vintage(loans: DataFrame, installments: DataFrame, snapshot: Snapshot) -> DataFrame:
    return vintage.vintage_kpis(loans, installments, snapshot.reference)

"""Cleaned tables: typed, one latest row per key, with quality flags.

Text is cast before rows are compared by recency: dates and doubles are narrower
than their texts, so less goes through the shuffle of the latest-row step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.functions import credit
from loanbook.functions.casting import safe_date, safe_double, safe_int, trimmed
from loanbook.functions.quality import customer_flags, loan_flags, payment_flags
from loanbook.operators.latest import latest_per_key
from loanbook.snapshot import Snapshot


def _as_text(raw: DataFrame, columns: list[str]) -> DataFrame:
    """Ingestion date and trimmed texts, each worked out once for all its uses.

    The ingestion date is a partition column, which Spark reads as a date where
    all partitions are named by one.
    """
    ingested = F.col(c.INGESTION_COLUMN)
    if dict(raw.dtypes)[c.INGESTION_COLUMN] != "date":
        ingested = safe_date(ingested.cast("string"))
    return raw.select(ingested.alias("data_ingestao"), *[trimmed(name).alias(name) for name in columns])


def typed_customers(raw: DataFrame) -> DataFrame:
    return _as_text(raw, c.RAW_COLUMNS["customers"]).select(
        "data_ingestao",
        "customer_id",
        "nome",
        safe_date(F.col("data_nascimento")).alias("data_nascimento"),
        safe_double(F.col("renda_mensal")).alias("renda_mensal"),
        safe_double(F.col("score_interno")).alias("score_interno"),
        F.upper("estado").alias("estado"),
        safe_date(F.col("data_cadastro")).alias("data_cadastro"),
    )


def typed_loans(raw: DataFrame) -> DataFrame:
    return _as_text(raw, c.RAW_COLUMNS["loans"]).select(
        "data_ingestao",
        "loan_id",
        "customer_id",
        safe_date(F.col("data_concessao")).alias("data_concessao"),
        safe_double(F.col("valor_contratado")).alias("valor_contratado"),
        safe_int(F.col("prazo_meses")).alias("prazo_meses"),
        safe_double(F.col("taxa_juros_anual")).alias("taxa_juros_anual"),
        F.lower("canal").alias("canal"),
        F.lower("status").alias("status_reportado"),
    )


def typed_payments(raw: DataFrame) -> DataFrame:
    return _as_text(raw, c.RAW_COLUMNS["payments"]).select(
        "data_ingestao",
        "payment_id",
        "loan_id",
        safe_date(F.col("data_vencimento")).alias("data_vencimento"),
        safe_date(F.col("data_pagamento")).alias("data_pagamento"),
        safe_double(F.col("valor_parcela")).alias("valor_parcela"),
        safe_double(F.col("valor_pago")).alias("valor_pago"),
        safe_int(F.col("atraso_dias")).alias("atraso_dias"),
    )


def visible_payments(raw: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Payments ingested by the reference date. The condition stands on the
    partition column, so later partitions are not read."""
    return typed_payments(raw).where(F.col("data_ingestao") <= snapshot.reference)


def stg_customers(raw: DataFrame) -> DataFrame:
    return latest_per_key(typed_customers(raw), "customer_id").withColumns(customer_flags())


def stg_loans(raw: DataFrame) -> DataFrame:
    yearly = F.col("taxa_juros_anual") / F.lit(100.0)
    return (
        latest_per_key(typed_loans(raw), "loan_id")
        .withColumns(loan_flags())
        .withColumn("taxa_anual_decimal", yearly)
        .withColumn(
            "pmt_teorica",
            credit.theoretical_payment(
                F.col("valor_contratado"), F.col("prazo_meses"), F.col("taxa_anual_decimal")
            ),
        )
    )


def stg_payments(raw: DataFrame, snapshot: Snapshot) -> DataFrame:
    visible = visible_payments(raw, snapshot)
    return latest_per_key(visible, "payment_id").withColumns(payment_flags())

"""Default curves by month of origination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.functions import credit

KPI = "vintage_default_90"


def installment_defaults(installments: DataFrame, reference: Column) -> DataFrame:
    """Dated installments with the day they reached 90 days past due, if any."""
    reached = credit.default_date(
        F.col("data_vencimento"), F.col("data_pagamento"), F.col("dpd_efetivo"), reference
    )
    return installments.where(F.col("data_vencimento").isNotNull()).select(
        "loan_id", "data_vencimento", reached.alias("data_default_90_parcela")
    )


def first_defaults(loans: DataFrame, installments: DataFrame, reference: Column) -> DataFrame:
    """Dated loans with their cohort month and first default date, if any."""
    first = (
        installment_defaults(installments, reference)
        .where(F.col("data_default_90_parcela").isNotNull())
        .groupBy("loan_id")
        .agg(F.min("data_default_90_parcela").alias("data_default_90"))
    )
    granted = F.col("data_concessao")
    return (
        loans.where(granted.isNotNull())
        .select("loan_id", "data_concessao", F.trunc(granted, "month").alias("coorte_origem_mes"))
        .join(first, "loan_id", "left")
    )


def vintage_curve(
    first_default: DataFrame, reference: Column, max_age: int = c.VINTAGE_MONTHS
) -> DataFrame:
    """Eligible and defaulted loans per cohort and age in months 1..max_age.

    A loan is eligible at every age it completed by the reference date and in
    default from the first age that reaches its default date. Counting loans per
    (cohort, completed age, default age) first leaves at most (max_age+1)²
    rows per cohort, and only those are spread over the ages.
    """
    granted, defaulted = F.col("data_concessao"), F.col("data_default_90")
    completed = F.coalesce(credit.months_completed(granted, reference), F.lit(0))
    reached = F.coalesce(credit.months_to_reach(granted, defaulted), F.lit(max_age + 1))
    counted = (
        first_default.groupBy(
            "coorte_origem_mes",
            F.greatest(F.least(completed, F.lit(max_age)), F.lit(0)).alias("_completed"),
            F.greatest(F.least(reached, F.lit(max_age + 1)), F.lit(1)).alias("_reached"),
        )
        .agg(F.count(F.lit(1)).alias("_loans"))
        .withColumn("idade_meses", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(max_age).cast("long"))))
    )
    eligible = F.col("_completed") >= F.col("idade_meses")
    in_default = eligible & (F.col("_reached") <= F.col("idade_meses"))
    return counted.groupBy("coorte_origem_mes", "idade_meses").agg(
        F.sum(F.when(eligible, F.col("_loans")).otherwise(0)).alias("elegiveis"),
        F.sum(F.when(in_default, F.col("_loans")).otherwise(0)).alias("em_default"),
    )


def vintage_kpis(
    loans: DataFrame, installments: DataFrame, reference: Column, max_age: int = c.VINTAGE_MONTHS
) -> DataFrame:
    """Share of eligible loans in default, per cohort and age; NULL where no
    loan of the cohort has reached the age."""
    curve = vintage_curve(first_defaults(loans, installments, reference), reference, max_age)
    return curve.select(
        reference.alias("data_referencia"),
        "coorte_origem_mes",
        "idade_meses",
        F.lit(KPI).alias("kpi_nome"),
        credit.ratio(F.col("em_default"), F.col("elegiveis")).alias("kpi_valor"),
        F.lit(c.KPI_DESCRIPTIONS[KPI]).alias("kpi_descricao"),
    )


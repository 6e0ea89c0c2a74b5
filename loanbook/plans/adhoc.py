"""Ad-hoc questions on the loan table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.functions.credit import ratio


def default_rate_90(loans: DataFrame) -> DataFrame:
    """Loans at 90+ days past due over live loans."""
    late = F.count_if(F.col("dpd_atual") >= 90)
    live = F.count_if(F.col("status_derivado").isin(c.LIVE_STATUSES))
    return loans.agg(ratio(late, live).alias("taxa_inadimplencia_90"))


def par_ratios(loans: DataFrame) -> DataFrame:
    """Open balance more than 30 and more than 90 days late, over the open
    balance of live loans."""
    balance, dpd = F.col("saldo_em_aberto_aprox"), F.col("dpd_atual")
    total = F.sum(balance)
    return loans.where(F.col("status_derivado").isin(c.LIVE_STATUSES)).agg(
        *[
            ratio(F.sum(F.when(dpd > days, balance).otherwise(0.0)), total).alias(f"par{days}")
            for days in (30, 90)
        ]
    )


def origination_vintage(loans: DataFrame) -> DataFrame:
    """Loans, loans at 90+ days past due and their share, per grant month."""
    late = F.count_if(F.col("dpd_atual") >= 90)
    contracts = F.count(F.lit(1))
    return (
        loans.groupBy(F.trunc("data_concessao", "month").alias("mes_originacao"))
        .agg(
            contracts.alias("qtd_contratos"),
            late.alias("qtd_inadimplentes_90"),
            ratio(late, contracts).alias("taxa_inadimplencia_90"),
        )
        .orderBy("mes_originacao")
    )


def recurring_customer_share(loans: DataFrame) -> DataFrame:
    """Customers with more than one loan over all customers."""
    customers = loans.select("customer_id", "cliente_recorrente").distinct()
    share = ratio(F.count_if("cliente_recorrente"), F.count(F.lit(1)))
    return customers.agg(share.alias("pct_clientes_recorrentes"))

"""Portfolio indicators in long form: one row per indicator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.functions.credit import ratio
from loanbook.operators.performance import customer_contracts, loan_totals, status_from_totals

OF_LOANS = ["taxa_inadimplencia_contratos"]
OF_CUSTOMERS = ["pct_clientes_multiplos_contratos"]
OF_INSTALLMENTS = [
    "par30_valor_em_aberto",
    "par90_valor_em_aberto",
    "yield_efetivo_aprox",
    "pct_parcelas_pagas_em_dia",
]


def _entries(names: list[str], date: str = "data_referencia") -> list[Column]:
    """Entries (data_referencia, kpi_nome, kpi_valor, kpi_descricao) of a one-row measurement."""
    return [
        F.struct(
            F.col(date).alias("data_referencia"),
            F.lit(name).alias("kpi_nome"),
            F.col(name).cast("double").alias("kpi_valor"),
            F.lit(c.KPI_DESCRIPTIONS[name]).alias("kpi_descricao"),
        )
        for name in names
    ]


def _as_rows(measured: DataFrame, *entries: list[Column]) -> DataFrame:
    return measured.select(F.inline(F.array(*[entry for group in entries for entry in group])))


def _dated(reference: Column, name: str = "data_referencia") -> Column:
    """The as-of date, NULL where there was no row to measure."""
    return F.max(reference).alias(name)


def _installment_sums(reference: Column) -> dict[str, Column]:
    """The sums the installment indicators are made of."""
    dpd, still_open = F.col("dpd_efetivo"), F.col("valor_em_aberto")
    on_time = (F.col("status_parcela") == c.PAID) & (dpd <= 0)
    return {
        "par30_valor_em_aberto": F.sum(F.when(dpd >= 30, still_open).otherwise(0.0)),
        "par90_valor_em_aberto": F.sum(F.when(dpd >= 90, still_open).otherwise(0.0)),
        "_paid": F.sum("valor_pago"),
        "_due": F.sum("valor_devido"),
        "_on_time": F.count_if(on_time),
        "_fallen_due": F.count_if(F.col("data_vencimento") <= reference),
    }


def _with_shares(summed: DataFrame) -> DataFrame:
    return summed.withColumns(
        {
            "yield_efetivo_aprox": ratio(F.col("_paid"), F.col("_due")),
            "pct_parcelas_pagas_em_dia": ratio(F.col("_on_time"), F.col("_fallen_due")),
        }
    )


def installment_kpis(installments: DataFrame, reference: Column) -> DataFrame:
    """PAR30, PAR90, effective yield and on-time share in one pass."""
    sums = [total.alias(name) for name, total in _installment_sums(reference).items()]
    measured = _with_shares(installments.agg(_dated(reference), *sums))
    return _as_rows(measured, _entries(OF_INSTALLMENTS))


def loan_kpis(loans: DataFrame, reference: Column) -> DataFrame:
    """Share of loans in default."""
    defaulted = F.count_if(F.col("status_derivado") == c.DEFAULTED)
    share = ratio(defaulted, F.count(F.lit(1)))
    measured = loans.agg(_dated(reference), share.alias("taxa_inadimplencia_contratos"))
    return _as_rows(measured, _entries(OF_LOANS))


def _recurring_share() -> Column:
    return ratio(F.count_if("cliente_recorrente"), F.count(F.lit(1))).alias(
        "pct_clientes_multiplos_contratos"
    )


def customer_kpis(loans: DataFrame, reference: Column) -> DataFrame:
    """Share of customers with more than one contract."""
    measured = customer_contracts(loans).agg(_dated(reference), _recurring_share())
    return _as_rows(measured, _entries(OF_CUSTOMERS))


def daily_kpis(loans: DataFrame, installments: DataFrame, reference: Column) -> DataFrame:
    """The six indicators of one snapshot, from the stored loan and installment tables."""
    parts = [
        loan_kpis(loans, reference),
        installment_kpis(installments, reference),
        customer_kpis(loans, reference),
    ]
    return reduce(DataFrame.unionByName, parts)


def daily_kpis_in_one_pass(loans: DataFrame, installments: DataFrame, reference: Column) -> DataFrame:
    """The six indicators from cleaned loans and installments that are still a plan.

    The installments are worked out once and summed up per loan, which gives both
    their own indicators and, since only a loan with overdue installments derives
    as defaulted, the defaulted loans. The customer grouping gives the number of
    loans. Two one-row measurements are laid over each other by union and max.
    """
    sums = _installment_sums(reference)
    per_loan = loan_totals(installments, *[total.alias(name) for name, total in sums.items()])
    defaulted = F.col("loan_id").isNotNull() & (status_from_totals() == c.DEFAULTED)
    of_installments = per_loan.agg(
        _dated(reference, "_measured_on"),
        F.count_if(defaulted).alias("_defaulted"),
        *[F.sum(name).alias(name) for name in sums],
    )
    of_customers = customer_contracts(loans).agg(
        _dated(reference), F.sum("qtd_contratos_cliente").alias("_loans"), _recurring_share()
    )
    both = of_installments.unionByName(of_customers, allowMissingColumns=True)
    one_row = both.agg(*[F.max(name).alias(name) for name in both.columns])
    measured = _with_shares(one_row).withColumn(
        "taxa_inadimplencia_contratos", ratio(F.col("_defaulted"), F.col("_loans"))
    )
    return _as_rows(
        measured,
        _entries(OF_LOANS + OF_CUSTOMERS),
        _entries(OF_INSTALLMENTS, "_measured_on"),
    )

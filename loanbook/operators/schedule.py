"""Expected installments and their payments.

Installment n of a loan falls due 30·n days after the grant, so every due date
of a loan lies on one 30-day grid. Counting days from the epoch, a date has a
*phase* (day mod 30) and a *slot* (day div 30); a payment belongs to a loan's
schedule if the phases agree and its slot lies 1..term after the grant's slot.
That turns the match of schedule and payments into

* an inner join of payments with *loans* (one row per loan instead of one per
  installment) on loan and phase, which adaptive execution can split when one
  loan holds a large part of the payments, and
* the installments without any payment: per loan, phase and run of 60 slots,
  the filled slots are OR-ed into one 64-bit mask (pre-aggregated before the
  shuffle), and the schedule keeps the slots whose bit is not set.

Two payments for one due date make two rows; payments off the grid match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.functions import credit

SLOTS_PER_MASK = 60

SCHEDULE_COLUMNS = [
    "loan_id",
    "customer_id",
    "data_concessao",
    "prazo_meses",
    "status_reportado",
    "pmt_teorica",
    "numero_parcela",
    "data_vencimento",
]
#: What is read of a payment.
MATCHED_COLUMNS = ["loan_id", "data_vencimento", "data_pagamento", "valor_parcela", "valor_pago", "atraso_dias"]
PAYMENT_COLUMNS = [
    "data_pagamento",
    "valor_parcela_informada",
    "valor_pago_informado",
    "atraso_dias_informado",
    "dq_parcela_sem_registro_pagamento",
]


def _phase(date: str) -> Column:
    return F.pmod(F.unix_date(date), F.lit(c.GRID_DAYS))


def _slot(date: str) -> Column:
    day = F.unix_date(date)
    return ((day - F.pmod(day, F.lit(c.GRID_DAYS))) / c.GRID_DAYS).cast("long")


def _with_term(loans: DataFrame) -> DataFrame:
    return loans.where(F.col("prazo_meses") >= 1)


def _with_origin(loans: DataFrame) -> DataFrame:
    """A loan without a grant date is scheduled from slot 0."""
    return loans.withColumn("_origin", F.coalesce(_slot("data_concessao"), F.lit(0).cast("long")))


def _cell(run: Column, date: str) -> Column:
    """A run of slots and a phase as one number; unknown without a date."""
    return run * c.GRID_DAYS + _phase(date)


def _runs(loans: DataFrame) -> DataFrame:
    """Loans × runs of up to 60 consecutive grid slots covering their schedule.

    Exploding runs first keeps each array short whatever the term. The run alone
    is added to the loan: what follows from its grant date is not shuffled.
    """
    return (
        _with_origin(_with_term(loans))
        .withColumn(
            "_run",
            F.explode(
                F.sequence(
                    F.floor((F.col("_origin") + 1) / SLOTS_PER_MASK),
                    F.floor((F.col("_origin") + F.col("prazo_meses")) / SLOTS_PER_MASK),
                )
            ),
        )
        .drop("_origin")
    )


def _installments_of(runs: DataFrame) -> DataFrame:
    first = F.greatest(F.col("_origin") + 1, F.col("_run") * SLOTS_PER_MASK)
    last = F.least(
        F.col("_origin") + F.col("prazo_meses"),
        F.col("_run") * SLOTS_PER_MASK + SLOTS_PER_MASK - 1,
    )
    return (
        _with_origin(runs)
        .withColumn("_slot", F.explode(F.sequence(first, last)))
        .withColumn("numero_parcela", F.col("_slot") - F.col("_origin"))
        .withColumn(
            "data_vencimento",
            F.date_add("data_concessao", (F.col("numero_parcela") * c.GRID_DAYS).cast("int")),
        )
    )


def installment_schedule(loans: DataFrame) -> DataFrame:
    """The expected installments of every loan with a positive term."""
    return _installments_of(_runs(loans)).select(SCHEDULE_COLUMNS)


def _on_grid(payments: DataFrame) -> DataFrame:
    """Payments that could match at all, their loan under a name of its own."""
    usable = F.col("loan_id").isNotNull() & F.col("data_vencimento").isNotNull()
    return payments.where(usable).withColumnRenamed("loan_id", "_paid_loan")


def paid_on_grid(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments with the loan whose installment they are for, and its number."""
    number = credit.days_between(F.col("data_concessao"), F.col("data_vencimento")) / c.GRID_DAYS
    # the phase is a key that both sides work out, not a column that travels
    due = (F.col("_paid_loan") == F.col("loan_id")) & (_phase("data_vencimento") == _phase("data_concessao"))
    return (
        _on_grid(payments)
        .join(_with_term(loans), due)
        .withColumn("numero_parcela", number.cast("long"))
        .where(F.col("numero_parcela").between(1, F.col("prazo_meses")))
    )


def _paid_installments(loans: DataFrame, payments: DataFrame) -> DataFrame:
    reported = payments.select(
        "loan_id",
        "data_vencimento",
        "data_pagamento",
        F.col("valor_parcela").alias("valor_parcela_informada"),
        F.col("valor_pago").alias("valor_pago_informado"),
        F.col("atraso_dias").alias("atraso_dias_informado"),
    )
    return paid_on_grid(loans, reported).withColumn("dq_parcela_sem_registro_pagamento", F.lit(False))


def _unpaid_installments(loans: DataFrame, payments: DataFrame) -> DataFrame:
    slot = _slot("data_vencimento")
    run = F.floor(slot / SLOTS_PER_MASK)
    filled = (
        _on_grid(payments)
        .withColumn("_cell", _cell(run, "data_vencimento"))
        .withColumn("_bit", (slot - run * SLOTS_PER_MASK).cast("int"))
        .groupBy("_paid_loan", "_cell")
        .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_filled"))
    )
    bit = "shiftright(coalesce(_filled, 0L), cast(_slot - _run * {} as int)) & 1".format(SLOTS_PER_MASK)
    same = (F.col("_paid_loan") == F.col("loan_id")) & (F.col("_cell") == _cell(F.col("_run"), "data_concessao"))
    return (
        _installments_of(_runs(loans).join(filled, same, "left"))
        .where(F.expr(bit) == 0)
        .withColumn("dq_parcela_sem_registro_pagamento", F.lit(True))
    )


def match_payments(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """Every scheduled installment with each of its payments, or without one.

    Carries every column of ``loans``, one row per ``loan_id``.
    """
    paid = _paid_installments(loans, payments)
    unpaid = _unpaid_installments(loans, payments)
    carried = loans.columns + ["numero_parcela", "data_vencimento"]
    nothing = [F.lit(None).cast(paid.schema[name].dataType).alias(name) for name in PAYMENT_COLUMNS[:-1]]
    return paid.select(*carried, *PAYMENT_COLUMNS).union(
        unpaid.select(*carried, *nothing, PAYMENT_COLUMNS[-1])
    )


def installments(loans: DataFrame, payments: DataFrame, cut: Column) -> DataFrame:
    """Matched installments with amounts, status and days past due at ``cut``."""
    due = credit.amount_due(F.col("valor_parcela_informada"), F.col("pmt_teorica"))
    paid = credit.amount_paid(F.col("valor_pago_informado"))
    return (
        match_payments(loans, payments)
        .withColumns({"valor_devido": due, "valor_pago": paid})
        .withColumns(
            {
                "valor_em_aberto": credit.amount_open(F.col("valor_devido"), F.col("valor_pago")),
                "status_parcela": credit.installment_status(F.col("valor_devido"), F.col("valor_pago")),
                "data_corte": cut,
            }
        )
        .withColumn(
            "dpd_efetivo",
            credit.effective_dpd(
                F.col("status_parcela"),
                F.col("valor_em_aberto"),
                F.col("data_vencimento"),
                F.col("data_pagamento"),
                F.col("data_corte"),
            ),
        )
    )

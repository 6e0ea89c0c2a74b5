"""Daily indicators as of many dates in one pass.

A row of the installment table changes with the as-of date in few ways: a payment
becomes visible or gives way to a later version of itself, the installment falls
due, and while it is open it passes 30 and 90 days. So each installment and each
visible version of a payment on it become some events, an amount that begins or
ends to count at a date, and the indicators of all dates are running sums over
events. Installments are laid out and matched once for up to ``MOST_DATES``
dates; further ones take another pass. Dates are the cut date as well.

Hot keys: versions meet installments in an inner join, which adaptive execution
splits; which dates an installment has no payment at follows from one bit mask
for each loan and due date, OR-ed before the shuffle. Events are summed before
they are shuffled, by indicator and date.

Disk: every step is stored before the next one begins, and what it was made of
is removed then, so that the shuffles of two steps never lie beside each other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.functions import credit
from loanbook.operators.performance import customer_contracts
from loanbook.operators.schedule import installment_schedule, paid_on_grid
from loanbook.sources.folders import stored
from loanbook.sources.tables import staged

#: Dates in one pass: a bit each, in a mask of 64 bits.
MOST_DATES = 60
SUMS = ["paid", "due", "on_time", "fallen_due", "par30", "par90"]


def _dates_before(day: Column, dates: list[dt.date]) -> Column:
    """How many of the ascending dates lie before a day: the place of the first
    that does not. A day that is NULL comes after all of them."""
    number = sum((F.lit(date) < day).cast("int") for date in dates)
    return F.coalesce(number, F.lit(len(dates)))


VERSION_COLUMNS = ["loan_id", "data_vencimento", "data_pagamento", "valor_parcela", "valor_pago"]


def first_of_day(payments: DataFrame, dates: list[dt.date]) -> DataFrame:
    """One row of each key and ingestion date, of those visible at some date."""
    others = [name for name in payments.columns if name not in ("payment_id", "data_ingestao")]
    same_day = Window.partitionBy("payment_id", "data_ingestao").orderBy(*[F.asc_nulls_last(name) for name in others])
    # rows without an ingestion date, or with one after all dates, are visible at none
    visible = payments.where(F.col("data_ingestao") <= F.lit(dates[-1]))
    ranked = visible.withColumn("_rank", F.row_number().over(same_day)).where("_rank = 1")
    return ranked.select("payment_id", "data_ingestao", *VERSION_COLUMNS)


def payment_versions(first: DataFrame, dates: list[dt.date]) -> DataFrame:
    """The first rows of each day with the places of the dates at which they are the
    latest visible row of their key: from ``_from`` on, before ``_until``."""
    in_order = Window.partitionBy("payment_id").orderBy("data_ingestao")
    spans = first.withColumns(
        {
            "_from": _dates_before(F.col("data_ingestao"), dates),
            "_until": _dates_before(F.lead("data_ingestao").over(in_order), dates),
        }
    )
    return spans.where("_from < _until").select(*VERSION_COLUMNS, "_from", "_until")


@contextmanager
def stored_versions(payments: DataFrame, dates: list[dt.date]) -> Iterator[DataFrame]:
    """Versions in a table, while they are read for the match and for the dates
    without payment."""
    with ExitStack() as kept:
        with stored(first_of_day(payments, dates), "payment-days") as first:
            versions = kept.enter_context(stored(payment_versions(first, dates), "payment-versions"))
        yield versions


def _spans_without_payment(installments: DataFrame, versions: DataFrame, number: int) -> DataFrame:
    """Installments with each run of dates at which no payment on them is visible."""
    mask = F.expr("shiftleft(1L, _until) - shiftleft(1L, _from)")
    paid = versions.groupBy("loan_id", "data_vencimento").agg(F.bit_or(mask).alias("_paid"))
    rows = installments.join(paid, ["loan_id", "data_vencimento"], "left").withColumn("_paid", F.coalesce("_paid", F.lit(0).cast("long")))
    is_open = lambda place: f"(shiftright(_paid, {place}) & 1) = 0"
    starts = f"filter(sequence(0, {number - 1}), i -> {is_open('i')} and (i = 0 or not {is_open('i - 1')}))"
    ends = f"filter(sequence(1, {number}), i -> {is_open('i - 1')} and (i = {number} or not {is_open('i')}))"
    spans = F.arrays_zip(F.expr(starts).alias("_from"), F.expr(ends).alias("_until"))
    return rows.select("*", F.inline(spans)).drop("_paid")


def _paid(loans: DataFrame, versions: DataFrame) -> DataFrame:
    """Versions with the amount due of their installment, from the loans alone."""
    per_loan = loans.select("loan_id", "data_concessao", "prazo_meses", "pmt_teorica")
    return paid_on_grid(per_loan, versions).select(*VERSION_COLUMNS, "pmt_teorica", "_from", "_until")


def _unpaid(loans: DataFrame, versions: DataFrame, number: int) -> DataFrame:
    installments = installment_schedule(loans).select("loan_id", "data_vencimento", "pmt_teorica")
    return _spans_without_payment(installments, versions, number)


def _measured_spans(rows: DataFrame, dates: list[dt.date]) -> DataFrame:
    due = credit.amount_due(F.col("valor_parcela"), F.col("pmt_teorica"))
    paid = credit.amount_paid(F.col("valor_pago"))
    late = lambda days: _dates_before(F.date_add("data_vencimento", days), dates)
    dpd = F.when(F.col("data_pagamento").isNotNull(), credit.days_between(F.col("data_vencimento"), F.col("data_pagamento")))
    on_time = (credit.installment_status(due, paid) == c.PAID) & (F.coalesce(dpd, F.lit(0)) <= 0)
    return rows.select(
        "loan_id",
        due.alias("due"),
        paid.alias("paid"),
        credit.amount_open(due, paid).alias("open"),
        F.coalesce(on_time, F.lit(False)).cast("double").alias("on_time"),
        "_from",
        "_until",
        _dates_before(F.col("data_vencimento"), dates).alias("_due"),
        late(30).alias("_late30"),
        late(c.DEFAULT_DAYS).alias("_late90"),
    )


def span_parts(loans: DataFrame, versions: DataFrame, dates: list[dt.date]) -> list[DataFrame]:
    """Rows of the installment table with the places of the dates they hold at:
    ``loan_id``, amounts, whether paid on time, and ``_from``, ``_until``, with
    the places ``_due``, ``_late30`` and ``_late90`` from which they are due and
    so many days late. Those with a payment, and those without one."""
    nothing = {name: F.lit(None).cast(versions.schema[name].dataType) for name in VERSION_COLUMNS[2:]}
    unpaid = _unpaid(loans, versions, len(dates)).withColumns(nothing)
    return [_measured_spans(rows, dates) for rows in (_paid(loans, versions), unpaid)]


def installment_spans(loans: DataFrame, payments: DataFrame, dates: list[dt.date]) -> DataFrame:
    """Both parts of the spans, from typed payments."""
    with stored_versions(payments, dates) as versions:
        return staged(reduce(DataFrame.unionByName, span_parts(loans, versions, dates)), "installment-spans")


def running_sums(spans: DataFrame, number: int) -> DataFrame:
    """The sums of the installment indicators by place of the date: a value
    begins to count at one place and ends at another."""

    def events(name: str, value: Column, start: Column) -> list[Column]:
        begin = F.greatest(start, F.col("_from"))
        row = lambda at, change: F.struct(F.lit(name).alias("name"), at.alias("place"), change.alias("change"))
        value = F.when(begin < F.col("_until"), value)
        return [row(begin, value), row(F.col("_until"), -value)]

    whole, zero = F.lit(1.0), F.lit(0)
    every = [
        *events("paid", F.col("paid"), zero),
        *events("due", F.col("due"), zero),
        *events("on_time", F.col("on_time"), zero),
        *events("fallen_due", whole, F.col("_due")),
        *events("par30", F.col("open"), F.col("_late30")),
        *events("par90", F.col("open"), F.col("_late90")),
    ]
    changes = spans.select(F.inline(F.array(*every))).where(f"change <> 0 and place < {number}")
    changes = changes.groupBy("place").pivot("name", SUMS).agg(F.sum("change"))
    # a row for each date at most from here on
    places = spans.sparkSession.range(number).select(F.col("id").cast("int").alias("place"))
    before = Window.partitionBy(F.lit(0)).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = places.join(changes, "place", "left")
    return totals.select("place", *[F.coalesce(F.sum(name).over(before), F.lit(0.0)).alias(name) for name in SUMS])


def defaulted_loans(spans: DataFrame, number: int) -> DataFrame:
    """How many loans have an open installment 90 days late, by place."""
    late = spans.where(_in_default()).withColumn("_begin", F.greatest("_late90", "_from"))
    per_loan = late.groupBy("loan_id").agg(F.bit_or(F.expr("shiftleft(1L, _until) - shiftleft(1L, _begin)")).alias("_late"))
    each = per_loan.select(F.explode(F.expr(f"filter(sequence(0, {number - 1}), i -> (shiftright(_late, i) & 1) = 1)")).alias("place"))
    return each.groupBy("place").agg(F.count("*").alias("defaulted"))


def _in_default() -> Column:
    """Whether a span may put its loan in default."""
    return (F.col("open") > 0) & F.col("loan_id").isNotNull() & (F.greatest("_late90", "_from") < F.col("_until"))


def _measured(loans: DataFrame, payments: DataFrame, dates: list[dt.date]) -> DataFrame:
    """One row for each date, stored: what it was made of is removed."""
    number = len(dates)
    with ExitStack() as kept:
        with stored_versions(payments, dates) as versions:
            parts = []
            for part in span_parts(loans, versions, dates):
                # the loan is read of those in default only
                part = part.withColumn("loan_id", F.when(_in_default(), F.col("loan_id")))
                parts.append(kept.enter_context(stored(part, "installment-spans")))
        # read for the sums and for the loans in default
        spans = reduce(DataFrame.unionByName, parts)
        return staged(running_sums(spans, number).join(defaulted_loans(spans, number), "place", "left"), "measured-dates")


def _kpis_of(loans: DataFrame, payments: DataFrame, dates: list[dt.date]) -> DataFrame:
    shares = customer_contracts(loans).agg(
        F.sum("qtd_contratos_cliente").alias("loans"),
        credit.ratio(F.count_if("cliente_recorrente"), F.count(F.lit(1))).alias("recurring"),
    )
    # one row of loan counts beside one row for each date
    measured = _measured(loans, payments, dates).withColumn("_one", F.lit(1)).join(shares.withColumn("_one", F.lit(1)), "_one")
    values = {
        "taxa_inadimplencia_contratos": credit.ratio(F.coalesce("defaulted", F.lit(0)), F.col("loans")),
        "par30_valor_em_aberto": F.col("par30"),
        "par90_valor_em_aberto": F.col("par90"),
        "pct_clientes_multiplos_contratos": F.col("recurring"),
        "yield_efetivo_aprox": credit.ratio(F.col("paid"), F.col("due")),
        "pct_parcelas_pagas_em_dia": credit.ratio(F.col("on_time"), F.col("fallen_due")),
    }
    date = F.element_at(F.array(*map(F.lit, dates)), F.col("place") + 1)
    entries = [
        F.struct(
            date.alias("data_referencia"),
            F.lit(name).alias("kpi_nome"),
            value.cast("double").alias("kpi_valor"),
            F.lit(c.KPI_DESCRIPTIONS[name]).alias("kpi_descricao"),
        )
        for name, value in values.items()
    ]
    return measured.select(F.inline(F.array(*entries)))


def daily_kpis_of_dates(loans: DataFrame, payments: DataFrame, dates: list[dt.date]) -> DataFrame:
    """The six indicators as of each of the dates: the rows of as many snapshots
    with reference and cut on that date.

    ``loans`` are cleaned loans; ``payments`` typed payments of all ingestion
    dates, before the latest row of a key is looked for. With no installments or
    no loans the sums are 0 and the shares NULL, and rows are dated all the same.
    """
    dates = sorted(set(dates))
    if not dates:
        raise ValueError("no dates")
    parts = [dates[at : at + MOST_DATES] for at in range(0, len(dates), MOST_DATES)]
    return reduce(DataFrame.unionByName, [_kpis_of(loans, payments, part) for part in parts])

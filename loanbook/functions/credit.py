"""Loan and installment formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanbook import contract as c


def flag(predicate: Column) -> Column:
    """A two-valued flag: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """A double share; NULL when there is nothing to divide by."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def theoretical_payment(amount: Column, term: Column, yearly_rate: Column) -> Column:
    """Level installment of an annuity loan with a yearly effective rate.

    NULL without a positive amount and term or without a rate. Doubles only:
    a decimal 1/12 would lose digits.
    """
    growth = F.pow(F.lit(1.0) + yearly_rate, F.lit(1.0 / 12.0))
    monthly = growth - F.lit(1.0)
    discount = F.lit(1.0) - F.pow(F.lit(1.0) + monthly, -term.cast("double"))
    level = F.try_divide(amount * monthly, discount)
    straight = F.try_divide(amount, term.cast("double"))
    usable = (amount > 0) & (term > 0) & yearly_rate.isNotNull()
    return F.when(usable, F.when(yearly_rate == 0, straight).otherwise(level))


def amount_due(reported: Column, theoretical: Column) -> Column:
    return F.coalesce(reported, theoretical)


def amount_paid(reported: Column) -> Column:
    return F.coalesce(reported, F.lit(0.0))


def amount_open(due: Column, paid: Column) -> Column:
    """What is left to pay, never negative; an unknown due amount leaves nothing open."""
    return F.greatest(due - paid, F.lit(0.0))


def installment_status(due: Column, paid: Column) -> Column:
    return (
        F.when((paid == 0) & (due > 0), c.UNPAID)
        .when((due > 0) & (paid >= due), c.PAID)
        .when((paid > 0) & (paid < due), c.PARTLY_PAID)
        .otherwise(c.UNDEFINED)
    )


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def effective_dpd(status: Column, still_open: Column, due_on: Column, paid_on: Column, cut: Column) -> Column:
    """Days past due: to the cut date while open and overdue, to the payment
    date (may be negative) once paid in full, else zero."""
    overdue = (still_open > 0) & (due_on < cut)
    settled = (status == c.PAID) & paid_on.isNotNull()
    return (
        F.when(overdue, days_between(due_on, cut))
        .when(settled, days_between(due_on, paid_on))
        .otherwise(F.lit(0).cast("long"))
    )


def derived_status(open_balance: Column, current_dpd: Column) -> Column:
    return (
        F.when(open_balance == 0, c.SETTLED)
        .when(current_dpd >= c.DEFAULT_DAYS, c.DEFAULTED)
        .otherwise(c.ACTIVE)
    )


def default_date(due_on: Column, paid_on: Column, dpd: Column, reference: Column) -> Column:
    """The day an installment reached 90 days past due, if it did: by its
    effective DPD when a payment date exists, by the reference date otherwise."""
    late_payment = paid_on.isNotNull() & (dpd >= c.DEFAULT_DAYS)
    never_paid = paid_on.isNull() & (F.datediff(reference, due_on) >= c.DEFAULT_DAYS)
    return F.when(late_payment | never_paid, F.date_add(due_on, c.DEFAULT_DAYS))


def month_distance(start: Column, end: Column) -> Column:
    """Calendar months from the month of ``start`` to the month of ``end``."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def months_completed(start: Column, end: Column) -> Column:
    """Largest M with ``start`` + M months <= ``end`` (month ends clipped)."""
    months = month_distance(start, end)
    return F.when(F.add_months(start, months) <= end, months).otherwise(months - 1)


def months_to_reach(start: Column, end: Column) -> Column:
    """Smallest M with ``start`` + M months >= ``end`` (month ends clipped)."""
    months = month_distance(start, end)
    return F.when(F.add_months(start, months) >= end, months).otherwise(months + 1)

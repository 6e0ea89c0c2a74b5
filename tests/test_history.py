"""Indicators of many dates at once against one snapshot after the other."""

import datetime as dt

import pytest

from loanbook import Snapshot
from loanbook.operators import history
from loanbook.plans import gold, silver
from tests.tables import loan, payment, raw

DATES = [dt.date(2024, 1, 31) + dt.timedelta(days=17 * step) for step in range(14)]

LOANS = [
    loan("A", term="6"),
    loan("B", term="3", granted="2024-02-10", customer="C2"),
    loan("C", term="2", granted=None, customer="C2"),
    loan("D", term="4", amount=None),
    loan("E", term=None),
    loan("F", term="2", granted="2023-12-01", status="cancelado", customer=None),
    loan(None, term="3", customer="C3"),
]
PAYMENTS = [
    # paid on time, a later version of it, and one more after that
    payment("P1", "A", "2024-01-31", "2024-01-30", day="2024-01-31"),
    payment("P1", "A", "2024-01-31", "2024-01-30", paid="40", day="2024-03-15"),
    payment("P1", "A", "2024-03-01", "2024-05-30", paid="100", day="2024-05-01"),
    # two payments of one installment, one of them late by far, and a tie on one day
    payment("P2", "A", "2024-03-31", "2024-09-30", paid="60", day="2024-04-01"),
    payment("P3", "A", "2024-03-31", None, paid="30", day="2024-06-01"),
    payment("P4", "A", "2024-04-30", "2024-04-30", paid="10", day="2024-04-30"),
    payment("P4", "A", "2024-04-30", "2024-04-30", paid="90", day="2024-04-30"),
    # off the grid, without due date, without a loan, without a key, without an amount
    payment("P5", "B", "2024-03-12", "2024-03-12"),
    payment("P6", "B", None, "2024-03-12"),
    payment("P7", None, "2024-01-31", "2024-03-12"),
    payment(None, "B", "2024-03-11", "2024-03-01", day="2024-02-20"),
    payment("P8", "B", "2024-04-10", "2024-04-11", due_amount=None, paid=None, day="2024-03-02"),
    payment("P9", "F", "2023-12-31", "2024-08-01", due_amount="0", paid="0", day="2024-02-01"),
]


def both(spark, loans, payments, dates):
    loans = silver.stg_loans(raw(spark, "loans", loans))
    raw_payments = raw(spark, "payments", payments)
    found = gold.kpis_backfill(loans, silver.typed_payments(raw_payments), dates).collect()
    expected = []
    for date in sorted(set(dates)):
        day = Snapshot(date, date)
        installments = gold.int_installments(loans, silver.stg_payments(raw_payments, day), day)
        mart = gold.mart_credit_loans(gold.int_loan_performance(loans, installments, day))
        expected += gold.mart_kpis_daily(mart, installments, day).collect()
    told = lambda rows: {(row.data_referencia, row.kpi_nome): (row.kpi_valor, row.kpi_descricao) for row in rows}
    assert len(found) == len(told(found)) == 6 * len(set(dates))
    return told(found), told(expected)


@pytest.mark.parametrize("most", [60, 5])
def test_equals_separate_snapshots(spark, monkeypatch, most):
    monkeypatch.setattr(history, "MOST_DATES", most)
    dates = DATES if most == 5 else [DATES[0], *DATES[::4], DATES[-1]]
    found, expected = both(spark, LOANS, PAYMENTS, dates if most == 60 else DATES[2:9])
    assert found.keys() == expected.keys()
    for key, (value, description) in expected.items():
        assert found[key] == (pytest.approx(value, abs=1e-9) if value is not None else None, description), key


def test_spans_cover_each_date_once(spark):
    """Without fan-out every installment has one row at every date."""
    loans = silver.stg_loans(raw(spark, "loans", LOANS))
    payments = silver.typed_payments(raw(spark, "payments", [row for row in PAYMENTS if row[0] != "P3"]))
    spans = history.installment_spans(loans, payments, DATES).where("loan_id = 'A'").collect()
    for place in range(len(DATES)):
        assert sum(row._from <= place < row._until for row in spans) == 6


def test_dates_are_asked_for(spark):
    with pytest.raises(ValueError):
        history.daily_kpis_of_dates(None, None, [])


def test_what_dates_are_made_of_is_removed(spark, tmp_path, monkeypatch):
    """Each table goes once the next one is stored; the indicators remain."""
    from loanbook.sources import folders

    made, held = [], []
    write, remove = folders.scratch_path, folders.remove
    monkeypatch.setattr(folders, "scratch_path", lambda session, name: made.append(write(session, name)) or made[-1])
    monkeypatch.setattr(folders, "remove", lambda session, path: held.append(path) or remove(session, path))
    loans = silver.stg_loans(raw(spark, "loans", LOANS))
    rows = gold.kpis_backfill(loans, silver.typed_payments(raw(spark, "payments", PAYMENTS)), DATES)
    names = [path.rpartition("/")[2].rpartition("-")[0] for path in made]
    assert names == ["payment-days", "payment-versions", "installment-spans", "installment-spans"]
    assert held[0] == made[0] and held[1] == made[1] and sorted(held) == sorted(made)
    assert not any(folders.exists(spark, path) for path in made)
    assert rows.count() == 6 * len(DATES)


def test_rows_after_all_dates_are_not_sorted(spark):
    payments = silver.typed_payments(raw(spark, "payments", PAYMENTS))
    first = history.first_of_day(payments, DATES[:2]).collect()
    assert max(row.data_ingestao for row in first) <= DATES[1]
    assert sum(row.payment_id == "P1" for row in first) == 1 and not any(row.payment_id in ("P2", "P3", "P4") for row in first)

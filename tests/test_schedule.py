import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanbook import Snapshot
from loanbook.operators import schedule
from loanbook.plans import gold, silver
from tests.tables import loan, payment, raw

DAY = Snapshot("2024-06-30", "2024-06-30")


def book(spark, loans, payments):
    return (
        silver.stg_loans(raw(spark, "loans", loans)),
        silver.stg_payments(raw(spark, "payments", payments), DAY),
    )


def installments(spark, loans, payments):
    return gold.int_installments(*book(spark, loans, payments), DAY)


@pytest.mark.parametrize(
    ("term", "rows"), [("", 0), ("0", 0), ("-2", 0), ("1", 1), ("12", 12), ("60", 60), ("400", 400)]
)
def test_number_of_installments(spark, term, rows):
    loans, _ = book(spark, [loan("L1", granted="2024-01-31", term=term)], [])
    dues = schedule.installment_schedule(loans).orderBy("numero_parcela").collect()
    assert [row.numero_parcela for row in dues] == list(range(1, rows + 1))
    granted = dt.date(2024, 1, 31)
    assert [row.data_vencimento for row in dues] == [
        granted + dt.timedelta(days=30 * n) for n in range(1, rows + 1)
    ]


@pytest.mark.parametrize("granted", ["1969-12-30", "1950-03-01", "1970-01-01", "2024-02-29"])
def test_grid_works_on_both_sides_of_the_epoch(spark, granted):
    start = dt.date.fromisoformat(granted)
    paid = [payment(f"P{n}", "L1", str(start + dt.timedelta(days=30 * n))) for n in (1, 2, 70)]
    rows = installments(spark, [loan("L1", granted=granted, term="70")], paid)
    matched = rows.where("not dq_parcela_sem_registro_pagamento").select("numero_parcela").collect()
    assert sorted(row[0] for row in matched) == [1, 2, 70]
    assert rows.count() == 70


def test_loan_without_grant_date_is_scheduled_without_due_dates(spark):
    rows = installments(spark, [loan("L1", granted="", term="3")], [payment("P1", "L1", "2024-01-31")])
    assert [(row.numero_parcela, row.data_vencimento, row.dpd_efetivo) for row in rows.orderBy("numero_parcela").collect()] == [
        (1, None, 0),
        (2, None, 0),
        (3, None, 0),
    ]


def test_missing_keys_match_nothing(spark):
    rows = installments(spark, [loan(None, term="1")], [payment("P1", None, "2024-01-31")])
    assert [row.dq_parcela_sem_registro_pagamento for row in rows.collect()] == [True]


def test_two_payments_make_two_rows_and_off_grid_payments_none(spark):
    rows = installments(
        spark,
        [loan("L1", term="2")],
        [
            payment("P1", "L1", "2024-01-31"),
            payment("P2", "L1", "2024-01-31"),
            payment("P3", "L1", "2024-02-01"),
            payment("P4", "L1", "2024-03-31"),
            payment("P5", "other", "2024-01-31"),
        ],
    )
    assert Counter(row.numero_parcela for row in rows.collect()) == {1: 2, 2: 1}


def test_against_a_nested_loop(spark):
    pick = random.Random(7)
    start = dt.date(2023, 1, 1)
    loans = [
        loan(f"L{n}", granted=str(start + dt.timedelta(days=pick.randrange(90))), term=str(pick.randrange(0, 130)))
        for n in range(40)
    ]
    payments = [
        payment(f"P{n}", f"L{pick.randrange(45)}", str(start + dt.timedelta(days=pick.randrange(400))), paid=str(n))
        for n in range(3000)
    ]
    expected = Counter()
    for key, _, granted, _, term, *_ in loans:
        for n in range(1, int(term) + 1):
            due = dt.date.fromisoformat(granted) + dt.timedelta(days=30 * n)
            found = [float(p[5]) for p in payments if p[1] == key and p[2] == str(due)]
            expected.update((key, n, due, value) for value in found or [None])
    rows = installments(spark, loans, payments).select(
        "loan_id", "numero_parcela", "data_vencimento", "valor_pago_informado"
    )
    assert Counter(tuple(row) for row in rows.collect()) == expected


@pytest.mark.parametrize(
    ("due", "due_amount", "paid_on", "paid", "status", "still_open", "dpd"),
    [
        ("2024-01-31", "100", "2024-01-31", "100", "pago_integral", 0, 0),
        ("2024-01-31", "100", "2024-01-21", "100", "pago_integral", 0, -10),
        ("2024-01-31", "100", "2024-05-10", "120", "pago_integral", 0, 100),
        ("2024-01-31", "100", None, "100", "pago_integral", 0, 0),
        ("2024-01-31", "100", "2024-01-31", "40", "pago_parcial", 60, 151),
        ("2024-01-31", "100", None, "0", "nao_pago", 100, 151),
        ("2024-01-31", "100", None, "", "nao_pago", 100, 151),
        ("2024-01-31", "", None, "0", "nao_pago", 50, 151),
        ("2024-01-31", "-50", None, "0", "indefinido", 0, 0),
        ("2024-01-31", "100", None, "-10", "indefinido", 110, 151),
    ],
)
def test_amounts_status_and_arrears(spark, due, due_amount, paid_on, paid, status, still_open, dpd):
    row = installments(
        spark,
        [loan("L1", amount="50", term="1")],
        [payment("P1", "L1", due, paid_on, due_amount, paid)],
    ).first()
    assert (row.status_parcela, row.valor_em_aberto, row.dpd_efetivo) == (status, still_open, dpd)


def test_future_partial_payment_is_not_late(spark):
    row = installments(
        spark,
        [loan("L1", granted="2024-06-15", term="1")],
        [payment("P1", "L1", "2024-07-15", "2024-06-20", "100", "40")],
    ).first()
    assert (row.status_parcela, row.dpd_efetivo) == ("pago_parcial", 0)


def test_unknown_due_amount_owes_nothing(spark):
    row = installments(spark, [loan("L1", rate="", term="1")], []).first()
    assert (row.valor_devido, row.valor_em_aberto, row.status_parcela) == (None, 0.0, "indefinido")


def test_installment_mart_columns_and_missing_loan_key(spark):
    loans, payments = book(spark, [loan("L1", term="1"), loan(None, term="1", customer="C1")], [])
    people = silver.stg_customers(
        raw(spark, "customers", [("C1", "Ana", "", "", "", "sp", "", "2024-01-01")])
    )
    mart = gold.mart_credit_installments(loans, payments, people, DAY)
    assert len(mart.columns) == 25
    rows = {row.loan_id: row for row in mart.collect()}
    assert rows["L1"].nome == "Ana" and rows["L1"].prazo_meses == 1
    assert rows[None].nome == "Ana" and rows[None].prazo_meses is None and rows[None].pmt_teorica is None
    assert mart.where(F.col("loan_id") == "L1").first().estado == "SP"

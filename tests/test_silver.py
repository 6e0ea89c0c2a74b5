import datetime as dt

import pytest

from loanbook import Snapshot
from loanbook.plans import silver
from tests.tables import customer, loan, payment, raw


def by(rows, key):
    return {row[key]: row for row in rows.collect()}


def test_latest_row_wins_and_ties_are_settled(spark):
    rows = raw(
        spark,
        "loans",
        [
            loan("L1", amount="10", day="2024-01-01"),
            loan("L1", amount="20", day="2024-02-01"),
            loan(" L2 ", amount="7"),
            loan("L2", amount="5"),
            loan(None, amount="1"),
            loan(None, amount="2"),
        ],
    )
    loans = by(silver.stg_loans(rows), "loan_id")
    assert loans["L1"].valor_contratado == 20
    assert loans["L2"].valor_contratado == 5
    assert set(loans) == {"L1", "L2", None}


def test_loan_without_ingestion_date_comes_last(spark):
    rows = raw(spark, "loans", [loan("L1", amount="1", day=None), loan("L1", amount="2", day="2020-01-01")])
    assert by(silver.stg_loans(rows), "loan_id")["L1"].valor_contratado == 2


def test_only_payments_are_limited_by_the_reference_date(spark):
    rows = raw(
        spark,
        "payments",
        [
            payment("P1", "L1", "2024-01-31", paid="1", day="2024-01-01"),
            payment("P1", "L1", "2024-01-31", paid="2", day="2024-03-01"),
            payment("P2", "L1", "2024-01-31", day=None),
        ],
    )
    seen = by(silver.stg_payments(rows, Snapshot("2024-02-01", "2024-02-01")), "payment_id")
    assert set(seen) == {"P1"} and seen["P1"].valor_pago == 1
    assert silver.stg_payments(rows, Snapshot("no date", "2024-02-01")).count() == 0


def test_text_partition_names_are_cast(spark):
    rows = raw(spark, "payments", [payment("P1", "L1", "2024-01-31")])
    texts = rows.withColumn("ingestion_date", rows.ingestion_date.cast("string"))
    assert silver.stg_payments(texts, Snapshot("2024-02-01")).count() == 1


@pytest.mark.parametrize(
    ("amount", "term", "rate", "expected"),
    [
        ("1200", "12", "0", 100.0),
        ("1000", "1", "12", 1000 * 1.12 ** (1 / 12)),
        ("1000", "12", "12", 1000 * (1.12 ** (1 / 12) - 1) / (1 - 1.12 ** (-1))),
        ("1000", "12", "-5", 1000 * (0.95 ** (1 / 12) - 1) / (1 - 0.95 ** (-1))),
        ("1000", "0", "12", None),
        ("1000", "-6", "12", None),
        ("-1", "12", "12", None),
        ("0", "12", "12", None),
        ("", "12", "12", None),
        ("1000", "abc", "12", None),
        ("1000", "12", "", None),
        ("1000", "12", "1e-300", None),
    ],
)
def test_theoretical_payment(spark, amount, term, rate, expected):
    rows = raw(spark, "loans", [loan("L1", amount=amount, term=term, rate=rate)])
    value = silver.stg_loans(rows).first().pmt_teorica
    assert value == (None if expected is None else pytest.approx(expected, rel=1e-9))


def test_loan_flags(spark):
    bad = loan("L1", granted="31/12/1999", amount="-1", term="0", rate="-5", status="outro")
    missing = loan("L2", granted="", amount="", term="", rate="", status=None)
    good = loan("L3", term=" 12 ", status=" ATIVO ")
    loans = by(silver.stg_loans(raw(spark, "loans", [bad, missing, good])), "loan_id")
    flags = [name for name in loans["L1"].asDict() if name.startswith("dq_")]
    assert len(flags) == 8

    def raised(key):
        return {name for name in flags if loans[key][name]}

    assert raised("L1") == {
        "dq_data_concessao_nula",
        "dq_valor_contratado_nao_positivo",
        "dq_prazo_nao_positivo",
        "dq_taxa_negativa",
        "dq_status_invalido",
    }
    assert raised("L2") == {
        "dq_data_concessao_nula",
        "dq_valor_contratado_nulo",
        "dq_prazo_nulo",
        "dq_taxa_nula",
        "dq_status_invalido",
    }
    assert raised("L3") == set()
    assert loans["L3"].status_reportado == "ativo" and loans["L3"].prazo_meses == 12


def test_customer_and_payment_flags(spark):
    people = by(
        silver.stg_customers(
            raw(spark, "customers", [customer("C1", income="-1", state="XXX", born=""), customer("C2", state=None)])
        ),
        "customer_id",
    )
    assert people["C1"].dq_renda_negativa and people["C1"].dq_estado_invalido
    assert people["C1"].dq_data_nascimento_nula and not people["C1"].dq_renda_nula
    assert people["C2"].dq_estado_invalido and not people["C2"].dq_score_nulo
    paid = by(
        silver.stg_payments(
            raw(
                spark,
                "payments",
                [
                    payment("P1", "L1", "2024-01-31", "2024-01-30", "-1", "-1"),
                    payment("P2", "L1", "", None, "", ""),
                ],
            ),
            Snapshot("2024-02-01"),
        ),
        "payment_id",
    )
    assert paid["P1"].dq_data_pagamento_antes_vencimento and paid["P1"].dq_valor_pago_negativo
    assert paid["P1"].dq_valor_parcela_negativo and not paid["P1"].dq_data_vencimento_nula
    assert paid["P2"].dq_data_vencimento_nula and paid["P2"].dq_valor_parcela_nulo
    assert paid["P2"].dq_valor_pago_nulo and not paid["P2"].dq_data_pagamento_antes_vencimento


def test_snapshot_dates(spark):
    day = Snapshot(None, "not a date").pinned(spark)
    today = spark.sql("select current_date()").first()[0]
    assert day.data_referencia == today and day.data_corte == today
    assert Snapshot("not a date").pinned(spark).data_referencia == ""
    assert Snapshot(dt.date(2024, 1, 1), "2024-02-01").pinned(spark).data_corte == dt.date(2024, 2, 1)

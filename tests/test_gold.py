import datetime as dt
import random
from calendar import monthrange

import pytest
from pyspark.sql import functions as F

from loanbook import Snapshot
from loanbook.operators import kpis, performance, vintage
from loanbook.plans import adhoc, gold, silver
from tests.tables import loan, payment, raw

DAY = Snapshot("2024-12-31", "2024-12-31")


@pytest.fixture(scope="module")
def marts(spark):
    loans = [
        loan("none", term="0", status="ativo"),
        loan("null_pmt", rate="", term="2", status=None),
        loan("paid", term="1", amount="100", customer="C2", status="cancelado"),
        loan("late", term="2", amount="200", customer="C2", status="Inadimplente"),
        loan("fresh", granted="2024-12-15", term="1", customer=None, status="ativo"),
        loan(None, term="1", amount="300", customer=None, status="ativo"),
    ]
    payments = [
        payment("P1", "paid", "2024-01-31", "2024-03-05", "100", "100"),
        payment("P2", "late", "2024-01-31", "2024-01-31", "100", "100"),
    ]
    clean = silver.stg_loans(raw(spark, "loans", loans)).cache()
    paid = silver.stg_payments(raw(spark, "payments", payments), DAY)
    rows = gold.int_installments(clean, paid, DAY).cache()
    return clean, rows, gold.mart_credit_loans(gold.int_loan_performance(clean, rows, DAY)).cache()


def test_loan_performance(marts):
    loans = {row.loan_id: row for row in marts[2].collect()}
    assert len(loans) == 6
    assert loans["none"].dpd_atual is None and loans["none"].status_derivado == "ativo"
    assert loans["null_pmt"].status_derivado == "liquidado" and not loans["null_pmt"].dq_status_divergente
    assert loans["paid"].status_derivado == "liquidado" and loans["paid"].dq_status_divergente
    assert (loans["paid"].ever_30, loans["paid"].ever_90, loans["paid"].dpd_atual) == (1, 0, 0)
    late = loans["late"]
    assert (late.status_derivado, late.dq_status_divergente) == ("inadimplente", False)
    assert (late.dpd_atual, late.saldo_em_aberto_aprox, late.parcelas_sem_registro) == (305, 100.0, 1)
    assert loans["fresh"].status_derivado == "ativo"
    assert loans[None].saldo_em_aberto_aprox is None and loans[None].status_derivado == "ativo"


def test_recurrence_ignores_missing_customers(marts):
    loans = {row.loan_id: row for row in marts[2].collect()}
    assert (loans["paid"].qtd_contratos_cliente, loans["paid"].cliente_recorrente) == (2, True)
    assert (loans["none"].qtd_contratos_cliente, loans["none"].cliente_recorrente) == (2, True)
    assert loans["fresh"].qtd_contratos_cliente is None and loans["fresh"].cliente_recorrente is None
    stats = {row.customer_id: row.qtd_contratos_cliente for row in performance.customer_contracts(marts[0]).collect()}
    assert stats == {"C1": 2, "C2": 2, None: 2}


def test_contracts_are_counted_on_loans(marts):
    """The same rows as from the performance table; only loans are shuffled by customer."""
    clean, rows, mart = marts
    made = gold.credit_loans(clean, rows, DAY)
    assert made.dtypes == mart.dtypes
    assert sorted(map(str, made.collect())) == sorted(map(str, mart.collect()))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    totals, lookup = (plan.index(f"LeftOuter, ({key}") for key in ("loan_id", "(customer_id"))
    assert totals < lookup


def as_dict(rows):
    return {row.kpi_nome: (row.data_referencia, row.kpi_valor) for row in rows.collect()}


def test_daily_indicators(marts):
    loans, rows, loan_mart = marts
    got = as_dict(gold.mart_kpis_daily(loan_mart, rows, DAY))
    day = dt.date(2024, 12, 31)
    assert got["taxa_inadimplencia_contratos"] == (day, pytest.approx(1 / 6))
    assert got["par30_valor_em_aberto"] == (day, pytest.approx(400.0))
    assert got["par90_valor_em_aberto"] == (day, pytest.approx(400.0))
    assert got["pct_clientes_multiplos_contratos"] == (day, pytest.approx(1.0))
    assert got["yield_efetivo_aprox"] == (day, pytest.approx(200 / 1800))
    assert got["pct_parcelas_pagas_em_dia"] == (day, pytest.approx(1 / 6))


def test_one_pass_gives_the_same_indicators(marts):
    loans, rows, loan_mart = marts
    assert as_dict(gold.portfolio_kpis(loans, rows, DAY)) == as_dict(gold.mart_kpis_daily(loan_mart, rows, DAY))


def test_empty_input_still_gives_six_rows(marts):
    loans, rows, loan_mart = marts
    nothing = F.lit(False)
    for got in (
        as_dict(gold.mart_kpis_daily(loan_mart.where(nothing), rows.where(nothing), DAY)),
        as_dict(gold.portfolio_kpis(loans.where(nothing), rows.where(nothing), DAY)),
    ):
        assert len(got) == 6 and set(got.values()) == {(None, None)}


def test_loans_without_installments_leave_installment_indicators_undated(marts):
    loans, rows, loan_mart = marts
    only = loans.where("loan_id = 'none'")
    got = as_dict(gold.portfolio_kpis(only, rows.where(F.lit(False)), DAY))
    assert got == as_dict(gold.mart_kpis_daily(loan_mart.where("loan_id = 'none'"), rows.where(F.lit(False)), DAY))
    assert got["par30_valor_em_aberto"] == (None, None)
    assert got["taxa_inadimplencia_contratos"] == (dt.date(2024, 12, 31), 0.0)


def test_unknown_reference_date(marts):
    loans, rows, loan_mart = marts
    got = as_dict(gold.mart_kpis_daily(loan_mart, rows, Snapshot("no date", "2024-12-31")))
    assert got["par30_valor_em_aberto"][0] is None and got["pct_parcelas_pagas_em_dia"][1] is None
    curve = gold.mart_kpis_vintage(loan_mart, rows, Snapshot("no date", "2024-12-31")).collect()
    assert all(row.kpi_valor is None and row.data_referencia is None for row in curve) and len(curve) == 24


def test_adhoc_questions(marts):
    loan_mart = marts[2]
    assert adhoc.default_rate_90(loan_mart).first()[0] == pytest.approx(1 / 4)
    assert tuple(adhoc.par_ratios(loan_mart).first()) == pytest.approx((100 / 1300, 100 / 1300))
    months = {row.mes_originacao: tuple(row)[1:] for row in adhoc.origination_vintage(loan_mart).collect()}
    assert months[dt.date(2024, 1, 1)] == (5, 1, pytest.approx(0.2))
    assert months[dt.date(2024, 12, 1)] == (1, 0, 0.0)
    assert adhoc.recurring_customer_share(loan_mart).first()[0] == pytest.approx(2 / 3)


def add_months(day, months):
    year, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    return dt.date(year, month + 1, min(day.day, monthrange(year, month + 1)[1]))


def test_vintage_against_every_loan_at_every_age(spark):
    pick = random.Random(3)
    reference = dt.date(2024, 5, 31)
    grants = [dt.date(2023, 1, 29) + dt.timedelta(days=pick.randrange(500)) for _ in range(400)]
    grants += [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2023, 5, 31)]
    loans = [(g, None if pick.random() < 0.4 else g + dt.timedelta(days=pick.randrange(-40, 420))) for g in grants]
    rows = spark.createDataFrame(loans, "data_concessao date, data_default_90 date").withColumn(
        "coorte_origem_mes", F.trunc("data_concessao", "month")
    )
    got = {
        (row.coorte_origem_mes, row.idade_meses): (row.elegiveis, row.em_default)
        for row in vintage.vintage_curve(rows, F.lit(reference)).collect()
    }
    expected = {}
    for granted, defaulted in loans:
        for age in range(1, 13):
            at_age = add_months(granted, age)
            eligible, late = expected.get((granted.replace(day=1), age), (0, 0))
            eligible += at_age <= reference
            late += at_age <= reference and defaulted is not None and defaulted <= at_age
            expected[granted.replace(day=1), age] = (eligible, late)
    assert got == expected


def test_first_default_date(spark):
    loans = silver.stg_loans(
        raw(spark, "loans", [loan("L1", term="3", amount="300"), loan("L2", granted="2024-12-01", term="1"), loan("L3", granted="")])
    )
    paid = [
        payment("P1", "L1", "2024-01-31", "2024-02-10"),
        payment("P2", "L1", "2024-03-01", "2024-06-20"),
        payment("P3", "L1", "2024-03-31", None, "100", "100"),
    ]
    rows = gold.int_installments(loans, silver.stg_payments(raw(spark, "payments", paid), DAY), DAY)
    first = {row.loan_id: row for row in vintage.first_defaults(loans, rows, DAY.reference).collect()}
    assert set(first) == {"L1", "L2"}
    assert first["L1"].data_default_90 == dt.date(2024, 5, 30)
    assert first["L1"].coorte_origem_mes == dt.date(2024, 1, 1)
    assert first["L2"].data_default_90 is None


def test_invariants(marts):
    loans, rows, loan_mart = marts
    assert loan_mart.count() == loans.count()
    assert rows.where("valor_em_aberto < 0").count() == 0
    got = as_dict(kpis.installment_kpis(rows, DAY.reference))
    assert got["par90_valor_em_aberto"][1] <= got["par30_valor_em_aberto"][1]
    ages = gold.mart_kpis_vintage(loan_mart, rows, DAY).groupBy("coorte_origem_mes").count().collect()
    assert {row["count"] for row in ages} == {12}

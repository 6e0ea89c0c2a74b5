"""Hot keys: joins split them, the latest-row step sends one row per task."""

import pytest
from pyspark.sql import functions as F

from loanbook.operators import schedule
from loanbook.operators.joins import lookup
from loanbook.operators.latest import latest_per_key
from loanbook.operators.performance import customer_contracts


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def executed_plan(rows):
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString()


def loans_of(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("L"), "id").alias("loan_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("C"), "id")).alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 1).cast("int")).alias("data_concessao"),
        F.lit(12).alias("prazo_meses"),
        F.lit("ativo").alias("status_reportado"),
        F.lit(100.0).alias("pmt_teorica"),
    )


def payments_of(spark, n):
    """A third of the payments on one loan and one due date."""
    loan = F.when(F.col("id") % 3 == 0, F.lit("L1")).otherwise(F.concat(F.lit("L"), F.col("id") % 3000))
    number = F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 12 + 1).cast("int"))
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("P"), "id").alias("payment_id"),
        loan.alias("loan_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), number * 30).alias("data_vencimento"),
        F.lit("2024-02-01").cast("date").alias("data_pagamento"),
        F.lit(100.0).alias("valor_parcela"),
        F.rand(1).alias("valor_pago"),
        F.lit(0).alias("atraso_dias"),
    )


def test_payments_of_a_hot_loan_are_split(spark, small_skew_limits):
    loans = latest_per_key(loans_of(spark, 3000).withColumn("data_ingestao", F.current_date()), "loan_id")
    payments = payments_of(spark, 60_000)
    matched = schedule.match_payments(loans.drop("data_ingestao"), payments)
    plan = executed_plan(matched)
    assert "SortMergeJoin(skew=true)" in plan
    assert matched.where("loan_id = 'L1' and numero_parcela = 1").count() == 20_000
    assert matched.where("not dq_parcela_sem_registro_pagamento").count() == 60_000
    assert "Nested" not in plan and "Cartesian" not in plan


def test_loans_of_a_hot_customer_are_split(spark, small_skew_limits):
    loans = loans_of(spark, 60_000).repartition(8)
    joined = lookup(loans, customer_contracts(loans), "customer_id")
    assert "SortMergeJoin(skew=true)" in executed_plan(joined)
    assert joined.where("qtd_contratos_cliente = 20000").count() == 20_000
    assert joined.count() == 60_000


def test_latest_row_is_limited_before_the_shuffle(spark):
    rows = payments_of(spark, 1000).withColumn("data_ingestao", F.current_date())
    plan = latest_per_key(rows, "loan_id")._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_masks_are_built_before_the_shuffle(spark):
    plan = schedule.match_payments(loans_of(spark, 10), payments_of(spark, 10))
    assert "partial_bit_or" in plan._jdf.queryExecution().executedPlan().toString()

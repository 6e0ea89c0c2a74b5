"""Raw credit tables derived from the order-processing test tables.

customer → customers, orders → loans, lineitem with orders → payments, each
ingested in up to three batches. The expressions are plain SQL that Spark and
the checking database read alike; they add the dirt the cleaning must handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ingestion dates of the three batches.
BATCH_DATES = ["2000-03-31", "2000-06-30", "2000-09-30"]

# How raw columns follow from the test tables (b is the batch number).
# Many loans of every third customer go to a customer of their own, who is in no
# customer table, so that single-loan and unknown customers exist.
CUSTOMER_EXPRESSIONS = {
    "customer_id": "case when c_custkey % 17 = 0 then ' C' || cast(c_custkey as string) || ' ' else 'C' || cast(c_custkey as string) end",
    "nome": "c_name",
    "data_nascimento": "case when c_custkey % 23 = 0 then '' when c_custkey % 29 = 0 then '1985-02-30' else cast(date '1950-01-01' + cast(c_custkey * 7 % 18000 as int) as string) end",
    "renda_mensal": "case when c_custkey % 31 = 0 then 'n/a' else cast(c_acctbal as string) end",
    "score_interno": "case when c_custkey % 19 = 0 then '' else cast(300 + (c_custkey * 37 + b) % 701 as string) end",
    "estado": "case when c_custkey % 41 = 0 then 'XXX' when c_custkey % 2 = 1 then lower(substr('SPRJMGBARSPRSCGOPECE', cast(1 + 2 * (c_nationkey % 10) as int), 2)) else substr('SPRJMGBARSPRSCGOPECE', cast(1 + 2 * (c_nationkey % 10) as int), 2) end",
    "data_cadastro": "cast(date '1994-01-01' + cast(c_custkey % 365 as int) as string)",
}
LOAN_EXPRESSIONS = {
    "loan_id": "'L' || cast(o_orderkey as string)",
    "customer_id": "case when o_custkey % 3 = 0 and o_orderkey % 8 <> 0 then 'N' || cast(o_orderkey as string) else 'C' || cast(o_custkey as string) end",
    "data_concessao": "case when o_orderkey % 97 = 0 then '' when o_orderkey % 101 = 0 then '31/12/1999' else cast(cast(o_orderdate as date) as string) end",
    "valor_contratado": "case when o_orderkey % 89 = 0 then '-1.0' when o_orderkey % 83 = 0 then '' else cast(o_totalprice as string) end",
    "prazo_meses": "case when o_orderkey % 79 = 0 then '0' when o_orderkey % 157 = 0 then '-6' when o_orderkey % 73 = 0 then 'abc' when o_orderkey % 3 = 0 then ' ' || cast(1 + o_orderkey % 12 as string) || ' ' when o_orderkey % 61 = 0 then cast(1 + o_orderkey % 12 as string) || '.0' else cast(1 + o_orderkey % 12 as string) end",
    "taxa_juros_anual": "case when o_orderkey % 71 = 0 then '' when o_orderkey % 67 = 0 then '-5' else cast(o_orderkey % 40 as string) end",
    "canal": "case when o_orderkey % 5 = 0 then ' App ' when o_orderkey % 5 = 1 then 'SITE' when o_orderkey % 5 = 2 then 'loja' when o_orderkey % 5 = 3 then 'Parceiro' else 'Telefone' end",
    "status": "case when b = 1 then 'Inadimplente' when o_orderstatus = 'F' then 'Liquidado' when o_orderstatus = 'O' then ' ATIVO ' when o_orderkey % 4 = 0 then 'inadimplente' when o_orderkey % 4 = 1 then 'cancelado' when o_orderkey % 4 = 2 then 'ativo' else 'desconhecido' end",
}
PAYMENT_EXPRESSIONS = {
    "payment_id": "'P' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)",
    "loan_id": "'L' || cast(l_orderkey as string)",
    "data_vencimento": "case when l_partkey % 97 = 0 then '' else cast(cast(o_orderdate as date) + cast(30 * l_linenumber as int) + (case when l_partkey % 53 = 0 then 1 else 0 end) as string) end",
    "data_pagamento": "case when l_suppkey % 10 = 0 and b = 0 then '' else cast(cast(o_orderdate as date) + cast(30 * l_linenumber as int) + cast(l_partkey % 150 - 20 as int) as string) end",
    "valor_parcela": "case when l_partkey % 13 = 0 then '' when l_partkey % 199 = 0 then '-50.0' else cast(l_extendedprice as string) end",
    "valor_pago": "case when l_suppkey % 10 = 0 and b = 0 then '' when l_partkey % 211 = 0 then '-10.0' when l_partkey % 4 < 2 or b > 0 then cast(l_extendedprice as string) when l_partkey % 4 = 2 then cast(l_extendedprice * 0.5 as string) else '0' end",
    "atraso_dias": "case when l_suppkey % 10 = 0 and b = 0 then '' else cast(l_partkey % 150 - 20 as string) end",
}

# Which rows are seen again in the second and third batch.
CUSTOMER_BATCHES = ["true", "c_custkey % 7 = 0", "c_custkey % 11 = 0"]
LOAN_BATCHES = ["true", "o_orderkey % 7 = 0", "o_orderkey % 11 = 0"]
PAYMENT_BATCHES = [
    "true",
    "(l_orderkey + l_linenumber) % 7 = 0",
    "(l_orderkey + l_linenumber) % 11 = 0",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _batched(rows: DataFrame, conditions: list[str], expressions: dict[str, str]) -> DataFrame:
    """One row per batch a source row belongs to, with its ingestion date."""
    batches = [
        F.when(
            F.expr(condition),
            F.struct(F.lit(number).alias("b"), F.lit(date).cast("date").alias("ingestion_date")),
        )
        for number, (condition, date) in enumerate(zip(conditions, BATCH_DATES))
    ]
    batched = rows.select("*", F.inline(F.array_compact(F.array(*batches))))
    columns = [F.expr(text).alias(name) for name, text in expressions.items()]
    return batched.select(*columns, "ingestion_date")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(_table(spark, sf_dir, "customer"), CUSTOMER_BATCHES, CUSTOMER_EXPRESSIONS)


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(_table(spark, sf_dir, "orders"), LOAN_BATCHES, LOAN_EXPRESSIONS)


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    joined = lines.join(dates, lines.l_orderkey == dates.o_orderkey)
    return _batched(joined, PAYMENT_BATCHES, PAYMENT_EXPRESSIONS)


RAW_TABLES = {"customers": raw_customers, "loans": raw_loans, "payments": raw_payments}

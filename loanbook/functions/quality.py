"""Data-quality flags of the cleaned tables, by table and flag name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.functions.credit import flag


def customer_flags() -> dict[str, Column]:
    income, state = F.col("renda_mensal"), F.col("estado")
    return {
        "dq_data_nascimento_nula": F.col("data_nascimento").isNull(),
        "dq_renda_nula": income.isNull(),
        "dq_renda_negativa": flag(income < 0),
        "dq_score_nulo": F.col("score_interno").isNull(),
        "dq_estado_invalido": F.coalesce(F.length(state) != 2, F.lit(True)),
    }


def loan_flags() -> dict[str, Column]:
    amount, term, rate = F.col("valor_contratado"), F.col("prazo_meses"), F.col("taxa_juros_anual")
    known = F.col("status_reportado").isin(c.LOAN_STATUSES)
    return {
        "dq_data_concessao_nula": F.col("data_concessao").isNull(),
        "dq_valor_contratado_nulo": amount.isNull(),
        "dq_valor_contratado_nao_positivo": flag(amount <= 0),
        "dq_prazo_nulo": term.isNull(),
        "dq_prazo_nao_positivo": flag(term <= 0),
        "dq_taxa_nula": rate.isNull(),
        "dq_taxa_negativa": flag(rate < 0),
        "dq_status_invalido": ~flag(known),
    }


def payment_flags() -> dict[str, Column]:
    due_on, paid_on = F.col("data_vencimento"), F.col("data_pagamento")
    due, paid = F.col("valor_parcela"), F.col("valor_pago")
    return {
        "dq_data_vencimento_nula": due_on.isNull(),
        "dq_valor_parcela_nulo": due.isNull(),
        "dq_valor_parcela_negativo": flag(due < 0),
        "dq_valor_pago_nulo": paid.isNull(),
        "dq_valor_pago_negativo": flag(paid < 0),
        "dq_data_pagamento_antes_vencimento": flag(paid_on < due_on),
    }

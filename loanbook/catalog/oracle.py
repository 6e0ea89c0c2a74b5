"""Checking SQL: the credit tables stated over again as common table expressions.

Written for the checking database, from the table definitions rather than from
the Spark plans: the schedule is a series join, payments meet it in an outer
join, and the default curve spreads loans over the ages. Literals such as ``1e0``
are doubles; ``1.0`` would be a decimal and change the type of a result.
"""

from __future__ import annotations

from loanbook import contract as c
from loanbook.sources import driver_tables as d


def _raw(source: str, expressions: dict[str, str], batches: list[str]) -> str:
    columns = ", ".join(f"{text} as {name}" for name, text in expressions.items())
    seen = " or ".join(f"(b = {number} and {condition})" for number, condition in enumerate(batches))
    return f"select {columns}, ingestion_date from {source}, batches where ({seen})"


def _latest(source: str, key: str, others: list[str]) -> str:
    order = ", ".join(f"{name} asc nulls last" for name in others)
    return (
        f"select * from {source} qualify row_number() over "
        f"(partition by {key} order by data_ingestao desc nulls last, {order}) = 1"
    )


def _kpi(name: str, value: str, source: str, day: str) -> str:
    return (
        f"select max(date '{day}') as data_referencia, '{name}' as kpi_nome, "
        f"cast({value} as double) as kpi_valor, '{c.KPI_DESCRIPTIONS[name]}' as kpi_descricao from {source}"
    )


def definitions(day: str) -> dict[str, str]:
    """All tables as of ``day``, which is both the reference and the cut date."""
    return {
        "batches": "select b, cast(day as date) as ingestion_date from (values "
        + ", ".join(f"({number}, '{day}')" for number, day in enumerate(d.BATCH_DATES))
        + ") as t(b, day)",
        "raw_customers": _raw("customer", d.CUSTOMER_EXPRESSIONS, d.CUSTOMER_BATCHES),
        "raw_loans": _raw("orders", d.LOAN_EXPRESSIONS, d.LOAN_BATCHES),
        "raw_payments": _raw(
            "lineitem join orders on l_orderkey = o_orderkey", d.PAYMENT_EXPRESSIONS, d.PAYMENT_BATCHES
        ),
        "typed_customers": """
            select ingestion_date as data_ingestao, trim(customer_id) as customer_id, trim(nome) as nome,
                try_cast(trim(data_nascimento) as date) as data_nascimento,
                try_cast(trim(renda_mensal) as double) as renda_mensal,
                try_cast(trim(score_interno) as double) as score_interno,
                upper(trim(estado)) as estado, try_cast(trim(data_cadastro) as date) as data_cadastro
            from raw_customers""",
        "latest_customers": _latest(
            "typed_customers",
            "customer_id",
            ["nome", "data_nascimento", "renda_mensal", "score_interno", "estado", "data_cadastro"],
        ),
        "stg_customers": """
            select *, data_nascimento is null as dq_data_nascimento_nula, renda_mensal is null as dq_renda_nula,
                coalesce(renda_mensal < 0, false) as dq_renda_negativa, score_interno is null as dq_score_nulo,
                coalesce(length(estado) != 2, true) as dq_estado_invalido
            from latest_customers""",
        "typed_loans": """
            select ingestion_date as data_ingestao, trim(loan_id) as loan_id, trim(customer_id) as customer_id,
                try_cast(trim(data_concessao) as date) as data_concessao,
                try_cast(trim(valor_contratado) as double) as valor_contratado,
                try_cast(trim(prazo_meses) as integer) as prazo_meses,
                try_cast(trim(taxa_juros_anual) as double) as taxa_juros_anual,
                lower(trim(canal)) as canal, lower(trim(status)) as status_reportado
            from raw_loans""",
        "latest_loans": _latest(
            "typed_loans",
            "loan_id",
            [
                "customer_id",
                "data_concessao",
                "valor_contratado",
                "prazo_meses",
                "taxa_juros_anual",
                "canal",
                "status_reportado",
            ],
        ),
        "stg_loans": """
            select l.*, data_concessao is null as dq_data_concessao_nula,
                valor_contratado is null as dq_valor_contratado_nulo,
                coalesce(valor_contratado <= 0, false) as dq_valor_contratado_nao_positivo,
                prazo_meses is null as dq_prazo_nulo, coalesce(prazo_meses <= 0, false) as dq_prazo_nao_positivo,
                taxa_juros_anual is null as dq_taxa_nula, coalesce(taxa_juros_anual < 0, false) as dq_taxa_negativa,
                coalesce(status_reportado not in ('ativo', 'liquidado', 'inadimplente', 'cancelado'), true)
                    as dq_status_invalido,
                taxa_juros_anual / 1e2 as taxa_anual_decimal,
                power(1e0 + taxa_juros_anual / 1e2, 1e0 / 12e0) - 1e0 as juros_mensal,
                if(prazo_meses > 0 and valor_contratado > 0,
                    if(taxa_juros_anual = 0, valor_contratado / prazo_meses,
                        valor_contratado * juros_mensal / (1e0 - power(1e0 + juros_mensal, -prazo_meses))),
                    null) as pmt_teorica
            from latest_loans l""",
        "typed_payments": """
            select ingestion_date as data_ingestao, trim(payment_id) as payment_id, trim(loan_id) as loan_id,
                try_cast(trim(data_vencimento) as date) as data_vencimento,
                try_cast(trim(data_pagamento) as date) as data_pagamento,
                try_cast(trim(valor_parcela) as double) as valor_parcela,
                try_cast(trim(valor_pago) as double) as valor_pago,
                try_cast(trim(atraso_dias) as integer) as atraso_dias
            from raw_payments""",
        "visible_payments": f"select * from typed_payments where data_ingestao <= date '{day}'",
        "latest_payments": _latest(
            "visible_payments",
            "payment_id",
            ["loan_id", "data_vencimento", "data_pagamento", "valor_parcela", "valor_pago", "atraso_dias"],
        ),
        "stg_payments": """
            select *, data_vencimento is null as dq_data_vencimento_nula, valor_parcela is null as dq_valor_parcela_nulo,
                coalesce(valor_parcela < 0, false) as dq_valor_parcela_negativo, valor_pago is null as dq_valor_pago_nulo,
                coalesce(valor_pago < 0, false) as dq_valor_pago_negativo,
                coalesce(data_pagamento < data_vencimento, false) as dq_data_pagamento_antes_vencimento
            from latest_payments""",
        "schedule": """
            select loan_id, customer_id, data_concessao, prazo_meses, status_reportado, pmt_teorica, numero_parcela,
                cast(data_concessao + cast(30 * numero_parcela as integer) as date) as data_vencimento
            from stg_loans, unnest(range(1, prazo_meses + 1)) as series(numero_parcela)""",
        "matched": """
            select s.*, data_pagamento, valor_parcela as valor_parcela_informada, valor_pago as valor_pago_informado,
                atraso_dias as atraso_dias_informado, p.loan_id is null as dq_parcela_sem_registro_pagamento,
                coalesce(valor_parcela, pmt_teorica) as valor_devido, coalesce(valor_pago, 0e0) as valor_pago
            from schedule s left join stg_payments p using (loan_id, data_vencimento)""",
        "installments": f"""
            select *, greatest(valor_devido - valor_pago, 0e0) as valor_em_aberto, date '{day}' as data_corte,
                case when valor_devido > 0 and valor_pago = 0 then 'nao_pago'
                    when valor_devido > 0 and valor_pago >= valor_devido then 'pago_integral'
                    when valor_pago > 0 and valor_devido > valor_pago then 'pago_parcial'
                    else 'indefinido' end as status_parcela,
                valor_em_aberto > 0 and data_vencimento < date '{day}' as vencida_em_aberto,
                cast(case when vencida_em_aberto then date '{day}' - data_vencimento
                    when status_parcela = 'pago_integral' and data_pagamento is not null
                        then data_pagamento - data_vencimento
                    else 0 end as bigint) as dpd_efetivo
            from matched""",
        "totals": """
            select loan_id, max(if(vencida_em_aberto, dpd_efetivo, 0)) as dpd_atual,
                sum(valor_em_aberto) as saldo_em_aberto_aprox,
                count(*) filter (dq_parcela_sem_registro_pagamento) as parcelas_sem_registro,
                cast(bool_or(dpd_efetivo >= 30) as integer) as ever_30,
                cast(bool_or(dpd_efetivo >= 90) as integer) as ever_90
            from installments group by loan_id""",
        "performance": f"""
            select l.loan_id, customer_id, data_concessao, valor_contratado, prazo_meses, taxa_juros_anual,
                status_reportado, dpd_atual, saldo_em_aberto_aprox, parcelas_sem_registro, ever_30, ever_90,
                date '{day}' as data_corte,
                case when saldo_em_aberto_aprox = 0 then 'liquidado' when dpd_atual >= 90 then 'inadimplente'
                    else 'ativo' end as status_derivado,
                coalesce(lower(status_reportado) != status_derivado, false) as dq_status_divergente
            from stg_loans l left join totals using (loan_id)""",
        "recurrence": """
            select customer_id, count(*) as qtd_contratos_cliente, count(*) > 1 as cliente_recorrente
            from performance group by customer_id""",
        "loan_mart": """
            select p.*, qtd_contratos_cliente, cliente_recorrente
            from performance p left join recurrence r on p.customer_id = r.customer_id""",
        "installment_mart": """
            select i.loan_id, i.customer_id, numero_parcela, data_vencimento, data_pagamento, valor_devido,
                valor_pago, valor_em_aberto, status_parcela, dpd_efetivo, data_corte, l.data_concessao,
                l.valor_contratado, l.prazo_meses, l.taxa_juros_anual, l.canal, l.status_reportado, l.pmt_teorica,
                nome, data_nascimento, renda_mensal, score_interno, estado, data_cadastro,
                dq_parcela_sem_registro_pagamento
            from installments i left join stg_loans l on i.loan_id = l.loan_id
                left join stg_customers k on i.customer_id = k.customer_id""",
        "daily_kpis": " union all ".join(
            [
                _kpi(
                    "taxa_inadimplencia_contratos",
                    "count(*) filter (status_derivado = 'inadimplente') / nullif(count(*), 0)::double",
                    "loan_mart", day,
                ),
                _kpi("par30_valor_em_aberto", "sum(if(dpd_efetivo >= 30, valor_em_aberto, 0e0))", "installments", day),
                _kpi("par90_valor_em_aberto", "sum(if(dpd_efetivo >= 90, valor_em_aberto, 0e0))", "installments", day),
                _kpi(
                    "pct_clientes_multiplos_contratos",
                    "count(*) filter (cliente_recorrente) / nullif(count(*), 0)::double",
                    "recurrence", day,
                ),
                _kpi("yield_efetivo_aprox", "sum(valor_pago) / nullif(sum(valor_devido), 0)", "installments", day),
                _kpi(
                    "pct_parcelas_pagas_em_dia",
                    "count(*) filter (status_parcela = 'pago_integral' and dpd_efetivo <= 0)"
                    f" / nullif(count(*) filter (data_vencimento <= date '{day}'), 0)::double",
                    "installments", day,
                ),
            ]
        ),
        "defaults": f"""
            select loan_id, data_vencimento, case when if(data_pagamento is null,
                date '{day}' - data_vencimento >= 90, dpd_efetivo >= 90)
                then data_vencimento + 90 end as data_default_90_parcela
            from installments where data_vencimento is not null""",
        "first_defaults": """
            select loan_id, data_concessao, cast(date_trunc('month', data_concessao) as date) as coorte_origem_mes,
                (select min(data_default_90_parcela) from defaults f where f.loan_id = l.loan_id) as data_default_90
            from loan_mart l where data_concessao is not null""",
        "ages": """
            select coorte_origem_mes, idade_meses, data_default_90,
                cast(data_concessao + to_months(cast(idade_meses as integer)) as date) as na_idade
            from first_defaults, unnest(range(1, 13)) as series(idade_meses)""",
        "curve": f"""
            select coorte_origem_mes, idade_meses, count(*) filter (na_idade <= date '{day}') as elegiveis,
                count(*) filter (na_idade <= date '{day}' and data_default_90 <= na_idade) as em_default
            from ages group by all""",
        "vintage_kpis": f"""
            select date '{day}' as data_referencia, coorte_origem_mes, idade_meses, 'vintage_default_90' as kpi_nome,
                em_default / nullif(elegiveis, 0)::double as kpi_valor,
                '{c.KPI_DESCRIPTIONS["vintage_default_90"]}' as kpi_descricao
            from curve""",
    }


DAY = "2000-06-30"


def check(query: str, day: str = DAY) -> str:
    """The query with every table definition in front of it."""
    tables = ",\n".join(f"{name} as ({text})" for name, text in definitions(day).items())
    return f"with {tables}\n{query}"

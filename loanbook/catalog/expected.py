"""The checking SQL of every registered query."""

from __future__ import annotations

from loanbook import contract as c
from loanbook.catalog.fixed import AWKWARD_NAME, KEYS, MONTH_ENDS, REFRESHED, TOP_COLUMNS, TOP_VALUES
from loanbook.catalog.oracle import check

CUSTOMER_TYPES = {
    "data_ingestao": "date",
    "customer_id": "string",
    "nome": "string",
    "data_nascimento": "date",
    "renda_mensal": "double",
    "score_interno": "double",
    "estado": "string",
    "data_cadastro": "date",
}
LOAN_TYPES = {
    "data_ingestao": "date",
    "loan_id": "string",
    "customer_id": "string",
    "data_concessao": "date",
    "valor_contratado": "double",
    "prazo_meses": "int",
    "taxa_juros_anual": "double",
    "canal": "string",
    "status_reportado": "string",
    "taxa_anual_decimal": "double",
    "pmt_teorica": "double",
}
PAYMENT_TYPES = {
    "data_ingestao": "date",
    "payment_id": "string",
    "loan_id": "string",
    "data_vencimento": "date",
    "data_pagamento": "date",
    "valor_parcela": "double",
    "valor_pago": "double",
    "atraso_dias": "int",
}
CLEANED_TYPES = {"customers": CUSTOMER_TYPES, "loans": LOAN_TYPES, "payments": PAYMENT_TYPES}

CUSTOMER_FLAGS = [
    "dq_data_nascimento_nula",
    "dq_renda_nula",
    "dq_renda_negativa",
    "dq_score_nulo",
    "dq_estado_invalido",
]
LOAN_FLAGS = [
    "dq_data_concessao_nula",
    "dq_valor_contratado_nulo",
    "dq_valor_contratado_nao_positivo",
    "dq_prazo_nulo",
    "dq_prazo_nao_positivo",
    "dq_taxa_nula",
    "dq_taxa_negativa",
    "dq_status_invalido",
]
PAYMENT_FLAGS = [
    "dq_data_vencimento_nula",
    "dq_valor_parcela_nulo",
    "dq_valor_parcela_negativo",
    "dq_valor_pago_nulo",
    "dq_valor_pago_negativo",
    "dq_data_pagamento_antes_vencimento",
]

# Where the checking SQL keeps each table the declared checks name.
TABLE_OF = {
    "stg_customers": "stg_customers",
    "stg_loans": "stg_loans",
    "stg_payments": "stg_payments",
    "int_installments": "installments",
    "int_loan_performance": "performance",
    "mart_credit_installments": "installment_mart",
    "mart_credit_loans": "loan_mart",
    "mart_kpis_daily": "daily_kpis",
    "mart_kpis_vintage": "vintage_kpis",
}

SCHEDULED = "loan_id, customer_id, data_concessao, prazo_meses, status_reportado, round(pmt_teorica, 4) as pmt_teorica"
KPI_ROUNDED = (
    "data_referencia, kpi_nome, round(kpi_valor, if(starts_with(kpi_nome, 'par'), 2, 9)) as kpi_valor, kpi_descricao"
)
LOAN_MART = (
    "loan_id, customer_id, data_concessao, round(valor_contratado, 4) as valor_contratado, prazo_meses, "
    "round(taxa_juros_anual, 4) as taxa_juros_anual, status_reportado, dpd_atual, "
    "round(saldo_em_aberto_aprox, 4) as saldo_em_aberto_aprox, parcelas_sem_registro, ever_30, ever_90, "
    "data_corte, status_derivado, dq_status_divergente"
)


def _all(parts: list[str]) -> str:
    return " union all ".join(parts)


def _daily(day: str) -> str:
    return f"select {KPI_ROUNDED} from ({check('select * from daily_kpis', day)})"


def _refreshed(table: str, dated: str, key: str, value: str, digits: int, day: str) -> str:
    rows = check(f"select * from {TABLE_OF[table]}", day)
    return (
        f"select '{table}' as tabela, {dated} as dia, cast({key} as varchar) as chave, count(*) as linhas, "
        f"round(sum({value}), {digits}) as valor from ({rows}) group by all"
    )


def _shown(direction: str) -> str:
    parts = []
    for table, types in CLEANED_TYPES.items():
        key = KEYS[table][0]
        some = f"(select * from stg_{table} order by {key} {direction} nulls last limit 5)"
        for column, kind in types.items():
            text = f"cast({column} as decimal(20, 4))" if kind == "double" else column
            parts.append(
                f"select '{table}' as tabela, {key} as chave, '{column}' as coluna, cast({text} as varchar) as valor from {some}"
            )
    return _all(parts)


def _kpi(name: str) -> str:
    return f"select {KPI_ROUNDED} from daily_kpis where kpi_nome = '{name}'"


def _cast_audit(columns: list[tuple[str, str]], kind: str) -> str:
    texts = _all(
        [f"select '{name}' as coluna, trim({name}) as texto from raw_{table}" for table, name in columns]
    )
    return (
        f"select coluna, texto, count(*) as linhas, try_cast(texto as {kind}) as valor from ({texts}) group by all"
    )


def _flags(table: str, names) -> str:
    return _all([f"select '{name}' as flag, count(*) filter ({name}) as linhas from {table}" for name in names])


def _not_null() -> str:
    return _all(
        [
            f"select '{table}' as tabela, '{name}' as coluna, 'not_null' as teste, "
            f"count(*) filter ({name} is null) as violacoes from {TABLE_OF[table]}"
            for table, names in c.NOT_NULL.items()
            for name in names
        ]
    )


def _unique() -> str:
    return _all(
        [
            f"select '{table}' as tabela, '{name}' as coluna, 'unique' as teste, count(*) as violacoes from "
            f"(select {name} from {TABLE_OF[table]} where {name} is not null group by {name} having count(*) > 1)"
            for table, names in c.UNIQUE.items()
            for name in names
        ]
    )


def _nonnull() -> str:
    return _all(
        [
            f"select '{table}' as tabela, '{name}' as coluna, '{kind}' as tipo, count({name}) as nao_nulos from stg_{table}"
            for table, types in CLEANED_TYPES.items()
            for name, kind in types.items()
        ]
    )


def _nulls(columns: list[tuple[str, str]]) -> str:
    return _all(
        [
            f"select '{table}' as tabela, '{name}' as coluna, count(*) filter ({name} is null) as nulos from stg_{table}"
            for table, name in columns
        ]
    )


def _describe(columns: list[tuple[str, str]]) -> str:
    return _all(
        [
            f"select '{table}' as tabela, '{name}' as coluna, count({name}) as contagem, "
            f"round(avg({name}), 4) as media, round(stddev_samp({name}), 4) as desvio, "
            f"round(min({name})::double, 4) as minimo, "
            f"round(quantile_cont({name}::double, 0.25), 4) as q25, "
            f"round(quantile_cont({name}::double, 0.5), 4) as q50, "
            f"round(quantile_cont({name}::double, 0.75), 4) as q75, "
            f"round(max({name})::double, 4) as maximo from stg_{table}"
            for table, name in columns
        ]
    )


def _distinct(columns: list[tuple[str, str]]) -> str:
    return _all(
        [
            f"select distinct '{table}' as tabela, '{name}' as coluna, {name} as valor from stg_{table}"
            for table, name in columns
        ]
    )


def _frequencies(columns: list[tuple[str, str]]) -> str:
    return _all(
        [
            f"select '{table}' as tabela, '{name}' as coluna, {name} as valor, count(*) as frequencia "
            f"from stg_{table} where {name} is not null group by {name}"
            for table, name in columns
        ]
    )


INSTALLMENT_AMOUNTS = (
    "round(valor_devido, 4) as valor_devido, round(valor_pago, 4) as valor_pago, "
    "round(valor_em_aberto, 4) as valor_em_aberto"
)
INSTALLMENT_MART = f"""
        select loan_id, customer_id, numero_parcela, data_vencimento, data_pagamento, {INSTALLMENT_AMOUNTS},
            status_parcela, dpd_efetivo, data_corte, data_concessao,
            round(valor_contratado, 4) as valor_contratado, prazo_meses,
            round(taxa_juros_anual, 4) as taxa_juros_anual, canal, status_reportado,
            round(pmt_teorica, 4) as pmt_teorica, nome, data_nascimento,
            round(renda_mensal, 4) as renda_mensal, round(score_interno, 4) as score_interno, estado,
            data_cadastro, dq_parcela_sem_registro_pagamento
        from installment_mart"""
REPORTED = (
    "data_pagamento, round(valor_parcela_informada, 4) as valor_parcela_informada, "
    "round(valor_pago_informado, 4) as valor_pago_informado, atraso_dias_informado, "
    "dq_parcela_sem_registro_pagamento"
)

OVER_TABLES = {
    "csv_text_source": _all(
        [
            f"select '{table}' as tabela, {names[0]} as chave, "
            f"concat_ws('|', {', '.join(f"coalesce({name}, '')" for name in names)}) as campos from raw_{table}"
            for table, names in c.RAW_COLUMNS.items()
        ]
    ),
    "csv_typed_source": """
        select nullif(loan_id, '') as loan_id, nullif(customer_id, '') as customer_id,
            try_cast(trim(data_concessao) as date) as data_concessao,
            try_cast(trim(valor_contratado) as double) as valor_contratado,
            try_cast(trim(prazo_meses) as integer) as prazo_meses,
            try_cast(trim(taxa_juros_anual) as double) as taxa_juros_anual,
            nullif(canal, '') as canal, nullif(status, '') as status
        from raw_loans""",
    "bronze_roundtrip": "select * from raw_payments",
    "bronze_partition_counts": _all(
        [
            f"select '{table}' as tabela, ingestion_date, count(*) as linhas from raw_{table} group by ingestion_date"
            for table in c.RAW_COLUMNS
        ]
    ),
    "export_readback": f"select * replace ({AWKWARD_NAME} as nome) from ({INSTALLMENT_MART})",
    "normalize_text": "select "
    + ", ".join(f"trim({name}) as {name}" for name in c.RAW_COLUMNS["loans"])
    + " from raw_loans",
    "normalize_case": """
        select 'loans' as tabela, lower(trim(canal)) as a, lower(trim(status)) as b, count(*) as linhas
        from raw_loans group by all
        union all
        select 'customers', upper(trim(estado)) as a, null as b, count(*) from raw_customers group by all""",
    "safe_cast_date": _cast_audit(
        [
            ("customers", "data_nascimento"),
            ("customers", "data_cadastro"),
            ("loans", "data_concessao"),
            ("payments", "data_vencimento"),
            ("payments", "data_pagamento"),
        ],
        "date",
    ),
    "safe_cast_double": _cast_audit(
        [
            ("customers", "renda_mensal"),
            ("customers", "score_interno"),
            ("loans", "valor_contratado"),
            ("loans", "taxa_juros_anual"),
            ("payments", "valor_parcela"),
            ("payments", "valor_pago"),
        ],
        "double",
    ),
    "safe_cast_int": _cast_audit([("loans", "prazo_meses"), ("payments", "atraso_dias")], "integer"),
    "visible_payments": "select * from visible_payments",
    "latest_customers": "select * from latest_customers",
    "latest_loans": "select * from latest_loans",
    "latest_payments": "select * from latest_payments",
    "stg_customers": "select * from stg_customers",
    "stg_loans": """
        select * exclude (juros_mensal) replace (round(pmt_teorica, 4) as pmt_teorica,
            round(valor_contratado, 4) as valor_contratado, round(taxa_juros_anual, 4) as taxa_juros_anual,
            round(taxa_anual_decimal, 4) as taxa_anual_decimal)
        from stg_loans""",
    "stg_payments": "select * from stg_payments",
    "theoretical_pmt": """
        select loan_id, round(valor_contratado, 4) as valor_contratado, prazo_meses,
            round(taxa_anual_decimal, 4) as taxa_anual_decimal, round(pmt_teorica, 4) as pmt_teorica
        from stg_loans""",
    "installment_schedule": f"select {SCHEDULED}, numero_parcela, data_vencimento from schedule",
    "installment_payments": f"select {SCHEDULED}, numero_parcela, data_vencimento, {REPORTED} from installments",
    "installment_amounts": f"select loan_id, numero_parcela, {INSTALLMENT_AMOUNTS} from installments",
    "installment_status": """
        select status_parcela, dq_parcela_sem_registro_pagamento, count(*) as parcelas
        from installments group by all""",
    "installment_dpd": "select status_parcela, dpd_efetivo, count(*) as parcelas from installments group by all",
    "int_installments": f"""
        select {SCHEDULED}, numero_parcela, data_vencimento, {REPORTED}, {INSTALLMENT_AMOUNTS},
            status_parcela, data_corte, dpd_efetivo
        from installments""",
    "enriched_installments": """
        select canal, estado, status_parcela, count(*) as parcelas, count(nome) as com_cliente,
            round(cast(sum(cast(valor_em_aberto as decimal(18, 3))) as double), 3) as valor_em_aberto
        from installment_mart group by all""",
    "loan_open_balance": """
        select loan_id, dpd_atual, round(saldo_em_aberto_aprox, 4) as saldo_em_aberto_aprox,
            parcelas_sem_registro, ever_30, ever_90
        from totals""",
    "loan_performance": f"select {LOAN_MART} from performance",
    "derived_status_matrix": """
        select status_reportado, status_derivado, dq_status_divergente, count(*) as contratos
        from performance group by all""",
    "customer_contract_stats": "select * from recurrence",
    "mart_credit_installments": INSTALLMENT_MART,
    "mart_credit_loans": f"select {LOAN_MART}, qtd_contratos_cliente, cliente_recorrente from loan_mart",
    "mart_kpis_daily": f"select {KPI_ROUNDED} from daily_kpis",
    "kpi_default_rate": _kpi("taxa_inadimplencia_contratos"),
    "kpi_par30": _kpi("par30_valor_em_aberto"),
    "kpi_par90": _kpi("par90_valor_em_aberto"),
    "kpi_multi_contract": _kpi("pct_clientes_multiplos_contratos"),
    "kpi_yield": _kpi("yield_efetivo_aprox"),
    "kpi_on_time": _kpi("pct_parcelas_pagas_em_dia"),
    "installment_default_date": "select * from defaults",
    "first_default_date": "select * from first_defaults",
    "vintage_ages": "select * from curve",
    "mart_kpis_vintage": "select * replace (round(kpi_valor, 9) as kpi_valor) from vintage_kpis",
    "default_rate_90": """
        select round(count(*) filter (dpd_atual >= 90) / nullif(count(*) filter (status_derivado in ('ativo', 'inadimplente')), 0)::double, 9)
            as taxa_inadimplencia_90
        from loan_mart""",
    "par_ratios": """
        select round(sum(saldo_em_aberto_aprox) filter (dpd_atual > 30) / nullif(sum(saldo_em_aberto_aprox), 0), 9) as par30,
            round(sum(saldo_em_aberto_aprox) filter (dpd_atual > 90) / nullif(sum(saldo_em_aberto_aprox), 0), 9) as par90
        from loan_mart where status_derivado in ('ativo', 'inadimplente')""",
    "origination_vintage": """
        select cast(date_trunc('month', data_concessao) as date) as mes_originacao, count(*) as qtd_contratos,
            count(*) filter (dpd_atual >= 90) as qtd_inadimplentes_90,
            round(count(*) filter (dpd_atual >= 90) / count(*)::double, 9) as taxa_inadimplencia_90
        from loan_mart group by 1""",
    "recurring_customer_share": """
        select round(avg(if(cliente_recorrente, 1e0, 0e0)), 9) as pct_clientes_recorrentes
        from (select distinct customer_id, cliente_recorrente from loan_mart)""",
    "dq_customers": _flags("stg_customers", CUSTOMER_FLAGS),
    "dq_loans": _flags("stg_loans", LOAN_FLAGS),
    "dq_payments": _flags("stg_payments", PAYMENT_FLAGS),
    "dq_derived": """
        select 'int_installments' as tabela, 'dq_parcela_sem_registro_pagamento' as flag,
            count(*) filter (dq_parcela_sem_registro_pagamento) as linhas from installments
        union all
        select 'int_loan_performance', 'dq_status_divergente', count(*) filter (dq_status_divergente) from performance
        union all
        select 'raw_loans', 'prazo_meses_com_espaco', count(*) filter (prazo_meses != trim(prazo_meses)) from raw_loans""",
    "check_not_null": _not_null(),
    "check_unique": _unique(),
    "repeated_installments": """
        select loan_id, numero_parcela, data_vencimento, count(*) as linhas
        from installments group by all having count(*) > 1""",
    "profile_nonnull": _nonnull(),
    "profile_head": _shown("asc"),
    "profile_tail": _shown("desc"),
    "profile_distinct": _distinct(
        [
            ("customers", "customer_id"),
            ("customers", "nome"),
            ("loans", "loan_id"),
            ("loans", "customer_id"),
            ("payments", "payment_id"),
            ("payments", "loan_id"),
        ]
    ),
    "profile_nulls": _nulls(
        [
            ("customers", "data_nascimento"),
            ("customers", "data_cadastro"),
            ("loans", "data_concessao"),
            ("payments", "data_vencimento"),
            ("payments", "data_pagamento"),
        ]
    ),
    "profile_describe": _describe(
        [
            ("customers", "renda_mensal"),
            ("customers", "score_interno"),
            ("loans", "valor_contratado"),
            ("loans", "prazo_meses"),
            ("loans", "taxa_juros_anual"),
            ("payments", "valor_parcela"),
            ("payments", "valor_pago"),
            ("payments", "atraso_dias"),
        ]
    ),
    "profile_top_values": _all(
        [
            f"(select '{table}' as tabela, '{name}' as coluna, cast({name} as varchar) as valor, count(*) as frequencia "
            f"from stg_{table} where {name} is not null group by {name} order by count(*) desc, {name} limit {TOP_VALUES})"
            for table, name in TOP_COLUMNS
        ]
    ),
    "profile_value_counts": _frequencies(
        [("customers", "estado"), ("loans", "canal"), ("loans", "status_reportado")]
    ),
}


def oracle_sql() -> dict[str, str]:
    queries = {name: check(query) for name, query in OVER_TABLES.items()}
    queries["kpis_backfill"] = _all([_daily(day.isoformat()) for day in MONTH_ENDS])
    queries["incremental_upsert"] = _all([_daily("2000-03-31"), _daily("2000-06-30")])
    queries["full_refresh"] = _all(
        [_refreshed(*summed, day) for day in ("2000-03-31", "2000-06-30") for summed in REFRESHED[2 if day < "2000-06" else 0 :]]
    )
    return queries

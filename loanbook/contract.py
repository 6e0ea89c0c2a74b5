"""The data contract: fixed names and texts that inputs and outputs must carry."""

# Raw input columns, in file order.
RAW_COLUMNS = {
    "customers": [
        "customer_id",
        "nome",
        "data_nascimento",
        "renda_mensal",
        "score_interno",
        "estado",
        "data_cadastro",
    ],
    "loans": [
        "loan_id",
        "customer_id",
        "data_concessao",
        "valor_contratado",
        "prazo_meses",
        "taxa_juros_anual",
        "canal",
        "status",
    ],
    "payments": [
        "payment_id",
        "loan_id",
        "data_vencimento",
        "data_pagamento",
        "valor_parcela",
        "valor_pago",
        "atraso_dias",
    ],
}

# Fixed value: the partition column every raw table gets when it is ingested.
INGESTION_COLUMN = "ingestion_date"

# Loan statuses, installment statuses.
LOAN_STATUSES = ["ativo", "liquidado", "inadimplente", "cancelado"]
LIVE_STATUSES = ["ativo", "inadimplente"]
UNPAID, PAID, PARTLY_PAID, UNDEFINED = "nao_pago", "pago_integral", "pago_parcial", "indefinido"
SETTLED, DEFAULTED, ACTIVE = "liquidado", "inadimplente", "ativo"

# Days between installments, default threshold in days, vintage length in months.
GRID_DAYS = 30
DEFAULT_DAYS = 90
VINTAGE_MONTHS = 12

# Indicator names and their published descriptions.
KPI_DESCRIPTIONS = {
    "taxa_inadimplencia_contratos": "Percentual de contratos em inadimplência (status derivado >= 90 dpd).",
    "par30_valor_em_aberto": "Soma do valor em aberto em parcelas com dpd >= 30 (aproximação de PAR30).",
    "par90_valor_em_aberto": "Soma do valor em aberto em parcelas com dpd >= 90 (aproximação de PAR90).",
    "pct_clientes_multiplos_contratos": "Percentual de clientes com mais de um contrato (concentração de risco em recorrentes).",
    "yield_efetivo_aprox": "Razão entre valor pago e valor devido (proxy de yield realizado) nas parcelas observadas.",
    "pct_parcelas_pagas_em_dia": "Percentual de parcelas vencidas que foram pagas integralmente até a data de vencimento.",
    "vintage_default_90": "Percentual de contratos que já atingiram default (90+ DPD) até a idade M, por coorte de originação.",
}

# Upsert keys of the two indicator tables.
DAILY_KEYS = ["data_referencia", "kpi_nome"]
VINTAGE_KEYS = ["data_referencia", "coorte_origem_mes", "idade_meses", "kpi_nome"]

# Declared column checks per table.
NOT_NULL = {
    "stg_customers": ["customer_id"],
    "stg_loans": ["loan_id", "prazo_meses"],
    "stg_payments": ["payment_id"],
    "int_installments": ["loan_id", "numero_parcela", "data_vencimento"],
    "int_loan_performance": ["loan_id"],
    "mart_credit_installments": ["loan_id", "customer_id"],
    "mart_credit_loans": ["loan_id"],
    "mart_kpis_daily": ["data_referencia", "kpi_nome"],
    "mart_kpis_vintage": ["coorte_origem_mes", "idade_meses", "kpi_nome"],
}
UNIQUE = {
    "stg_customers": ["customer_id"],
    "stg_loans": ["loan_id"],
    "stg_payments": ["payment_id"],
    "int_loan_performance": ["loan_id"],
    "mart_credit_loans": ["loan_id"],
}

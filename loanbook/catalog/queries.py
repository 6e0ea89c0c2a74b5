"""Registered queries: every operator over the whole test tables.

Doubles are rounded here, and alike in the checking SQL, because two engines add
and exponentiate in different orders: amounts to a hundredth of a cent, which is
far above the last bits that differ and below the half cents the amounts hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook import Snapshot
from loanbook import contract as c
from loanbook.catalog.fixed import AWKWARD_NAME, KEYS, MONTH_ENDS, REFRESHED, TOP_COLUMNS, TOP_VALUES
from loanbook.functions import casting
from loanbook.functions.quality import customer_flags, loan_flags, payment_flags
from loanbook.operators import checks, kpis, performance, profile, schedule, vintage
from loanbook.plans import adhoc, gold, run, silver
from loanbook.sources import bronze, csv_files, driver_tables, folders, tables
from loanbook.sources.scratch import scratch_path, staged

SNAPSHOT = Snapshot("2000-06-30", "2000-06-30")
EARLIER = Snapshot("2000-03-31", "2000-03-31")


class OnDemand(dict):
    """Tables by name, each made when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self.makers = makers

    def __missing__(self, name: str) -> DataFrame:
        made = self[name] = self.makers[name]()
        return made


class Book:
    """The credit tables over one set of test tables, each a lazy plan."""

    def __init__(self, spark: SparkSession, sf_dir: str, snapshot: Snapshot = SNAPSHOT):
        self.spark, self.sf_dir, self.snapshot = spark, sf_dir, snapshot

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return {name: make(self.spark, self.sf_dir) for name, make in driver_tables.RAW_TABLES.items()}

    @cached_property
    def customers(self) -> DataFrame:
        return silver.stg_customers(self.raw["customers"])

    @cached_property
    def loans(self) -> DataFrame:
        return silver.stg_loans(self.raw["loans"])

    @cached_property
    def payments(self) -> DataFrame:
        return silver.stg_payments(self.raw["payments"], self.snapshot)

    @cached_property
    def cleaned(self) -> dict[str, DataFrame]:
        """The cleaned tables, stored where they are asked for: several tables
        build on each of them, and the latest row of a key is looked for once
        only. Of payments, what installments are matched with."""
        return OnDemand(
            {
                "customers": lambda: tables.staged(self.customers, "customers"),
                "loans": lambda: tables.staged(self.loans, "loans"),
                "payments": lambda: tables.staged(self._matched_payments, "payments"),
            }
        )

    @property
    def _matched_payments(self) -> DataFrame:
        return self.payments.select(schedule.MATCHED_COLUMNS)

    def of_snapshot(self, snapshot: Snapshot) -> Book:
        """The same tables as of another snapshot. Customers and loans hold no
        date of it and are not stored anew."""
        other = Book(self.spark, self.sf_dir, snapshot)
        shared = {name: lambda name=name: self.cleaned[name] for name in ("customers", "loans")}
        other.cleaned = OnDemand(other.cleaned.makers | shared)
        return other

    @cached_property
    def marted_payments(self) -> DataFrame:
        """What the two marts match. Stored before the match: what the latest-row
        step shuffled is gone by then, and no step of the match does it again."""
        return staged(self._matched_payments, "payments")

    @cached_property
    def installments(self) -> DataFrame:
        return gold.int_installments(self.cleaned["loans"], self.cleaned["payments"], self.snapshot)

    @cached_property
    def performance(self) -> DataFrame:
        return gold.int_loan_performance(self.cleaned["loans"], self.installments, self.snapshot)

    @cached_property
    def loan_mart(self) -> DataFrame:
        loans = self.cleaned["loans"]
        installments = gold.int_installments(loans, self.marted_payments, self.snapshot)
        return gold.credit_loans(loans, installments, self.snapshot)

    @cached_property
    def installment_mart(self) -> DataFrame:
        """Of loans and customers one described table is stored, which both steps
        of the match read."""
        described = tables.staged(gold.described_loans(self.loans, self.customers), "described-loans")
        return gold.installments_of_described(described, self.marted_payments, self.snapshot)

    @cached_property
    def daily_kpis(self) -> DataFrame:
        return gold.portfolio_kpis(self.cleaned["loans"], self.installments, self.snapshot)

    @cached_property
    def vintage_kpis(self) -> DataFrame:
        return gold.mart_kpis_vintage(self.cleaned["loans"], self.installments, self.snapshot)


READ_OF_INSTALLMENTS = [
    *performance.TOTALLED_COLUMNS,
    "numero_parcela",
    "data_pagamento",
    "valor_devido",
    "valor_pago",
    "status_parcela",
]


class StoredBook(Book):
    """The same tables with those that several others build on written to the
    scratch folder first, for questions that need many of them."""

    def _stored(self, name: str) -> DataFrame:
        return tables.staged(getattr(super(), name), name)

    @cached_property
    def customers(self) -> DataFrame:
        return self._stored("customers")

    @cached_property
    def loans(self) -> DataFrame:
        return self._stored("loans")

    @cached_property
    def payments(self) -> DataFrame:
        return tables.staged(super().payments.select("payment_id", *schedule.MATCHED_COLUMNS), "payments")

    @cached_property
    def cleaned(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "loans": self.loans, "payments": self.payments}

    @cached_property
    def installments(self) -> DataFrame:
        """What checks, the loan table and indicators read of them."""
        return tables.staged(super().installments.select(READ_OF_INSTALLMENTS), "installments")

    @cached_property
    def performance(self) -> DataFrame:
        return self._stored("performance")

    @cached_property
    def loan_mart(self) -> DataFrame:
        return gold.mart_credit_loans(self.performance)

    @cached_property
    def installment_mart(self) -> DataFrame:
        cleaned = self.cleaned
        return gold.mart_credit_installments(
            cleaned["loans"], cleaned["payments"], cleaned["customers"], self.snapshot
        )

    @cached_property
    def daily_kpis(self) -> DataFrame:
        return gold.mart_kpis_daily(self.loan_mart, self.installments, self.snapshot)

    @classmethod
    def of(cls, book: Book) -> StoredBook:
        return cls(book.spark, book.sf_dir, book.snapshot)


class KeyedBook(StoredBook):
    """Stored tables without installments, for questions where the loan table
    alone is made of these."""

    @cached_property
    def installments(self) -> DataFrame:
        return gold.int_installments(self.cleaned["loans"], self.cleaned["payments"], self.snapshot)


def rounded(rows: DataFrame, digits: int = 4, **by_column: int) -> DataFrame:
    """All double columns rounded, to their own number of digits where given."""
    doubles = [name for name, kind in rows.dtypes if kind == "double"]
    return rows.withColumns({name: F.round(name, by_column.get(name, digits)) for name in doubles})


# --- sources and sinks -------------------------------------------------------


def _as_csv(rows: DataFrame, name: str) -> str:
    path = scratch_path(rows.sparkSession, name)
    csv_files.write_csv(rows, path)
    return path


def csv_text_source(book: Book) -> DataFrame:
    """All three tables, each record with its table, key and fields."""
    read = {
        table: csv_files.read_text_csv(book.spark, _as_csv(book.raw[table].select(names), "csv-text"))
        for table, names in c.RAW_COLUMNS.items()
    }
    parts = [
        rows.select(
            F.lit(table).alias("tabela"), F.col(rows.columns[0]).alias("chave"), F.concat_ws("|", *rows.columns).alias("campos")
        )
        for table, rows in read.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def csv_typed_source(book: Book) -> DataFrame:
    rows = book.raw["loans"].select(c.RAW_COLUMNS["loans"])
    types = {
        "data_concessao": "date",
        "valor_contratado": "double",
        "prazo_meses": "int",
        "taxa_juros_anual": "double",
    }
    return csv_files.read_typed_csv(book.spark, _as_csv(rows, "csv-typed"), types)


def _bronze(book: Book, table: str) -> DataFrame:
    """The raw table written day by day, one day twice, and read back."""
    base = scratch_path(book.spark, "bronze")
    rows = book.raw[table].select(*c.RAW_COLUMNS[table], "ingestion_date")
    bronze.write_bronze_days(rows, base, table, driver_tables.BATCH_DATES)
    again = driver_tables.BATCH_DATES[0]
    batch = rows.where(F.col("ingestion_date") == F.lit(again).cast("date"))
    bronze.write_bronze(batch, base, table, again)
    return bronze.read_bronze(book.spark, base, f"{table}_raw")


def bronze_roundtrip(book: Book) -> DataFrame:
    return _bronze(book, "payments")


def bronze_partition_counts(book: Book) -> DataFrame:
    counts = [
        _bronze(book, table)
        .groupBy(F.lit(table).alias("tabela"), "ingestion_date")
        .agg(F.count(F.lit(1)).alias("linhas"))
        for table in c.RAW_COLUMNS
    ]
    return reduce(DataFrame.unionByName, counts)


def incremental_upsert(book: Book) -> DataFrame:
    """Daily indicators of two snapshots, the second run twice."""
    path = scratch_path(book.spark, "kpis-daily")
    earlier = Book(book.spark, book.sf_dir, EARLIER)
    later = earlier.of_snapshot(SNAPSHOT)
    for of_day in (earlier, later, later):
        stored = tables.upsert(of_day.daily_kpis, path, c.DAILY_KEYS)
    return _kpi_rounded(stored)


def kpis_backfill(book: Book) -> DataFrame:
    """Twelve month ends at once, with reference and cut on each of them."""
    payments = silver.typed_payments(book.raw["payments"])
    return _kpi_rounded(gold.kpis_backfill(tables.staged(book.loans, "loans"), payments, MONTH_ENDS))


def export_readback(book: Book) -> DataFrame:
    path = scratch_path(book.spark, "export")
    described = gold.described_loans(book.loans, book.customers)
    # what the table is made of is gone once it is exported
    with folders.stored(described, "described-loans") as loans, folders.stored(book._matched_payments, "payments") as payments:
        mart = rounded(gold.installments_of_described(loans, payments, book.snapshot))
        mart = mart.withColumn("nome", F.expr(AWKWARD_NAME))
        # as plain text it would be larger by far than the tables it is made of
        tables.export_csv(mart, path, compression="gzip")
        types = dict(mart.dtypes)
    return csv_files.read_typed_csv(book.spark, path, types)


def full_refresh(book: Book) -> DataFrame:
    """The stored run: raw tables ingested, two snapshots refreshed, the later
    one twice, and its four result tables read back and summed up."""
    lake = scratch_path(book.spark, "lake")
    for table, rows in book.raw.items():
        bronze.write_bronze_days(rows, f"{lake}/bronze", table, driver_tables.BATCH_DATES)
    for snapshot in (EARLIER, SNAPSHOT, SNAPSHOT):
        run.refresh(book.spark, lake, snapshot)
    stored = {name: tables.read_table(book.spark, f"{lake}/gold/{name}") for name in run.EXPORTED}
    counted = [
        stored[name].groupBy(
            F.lit(name).alias("tabela"),
            F.col(day).alias("dia"),
            F.col(key).cast("string").alias("chave"),
        ).agg(F.count(F.lit(1)).alias("linhas"), F.round(F.sum(value), digits).alias("valor"))
        for name, day, key, value, digits in REFRESHED
    ]
    return reduce(DataFrame.unionByName, counted)




# --- cleaning ----------------------------------------------------------------


def normalize_text(book: Book) -> DataFrame:
    names = c.RAW_COLUMNS["loans"]
    return book.raw["loans"].select([casting.trimmed(name).alias(name) for name in names])


def normalize_case(book: Book) -> DataFrame:
    typed = silver.typed_loans(book.raw["loans"])
    loans = typed.select(
        F.lit("loans").alias("tabela"), F.col("canal").alias("a"), F.col("status_reportado").alias("b")
    )
    states = silver.typed_customers(book.raw["customers"]).select(
        F.lit("customers").alias("tabela"), F.col("estado").alias("a"), F.lit(None).cast("string").alias("b")
    )
    both = loans.unionByName(states)
    return both.groupBy("tabela", "a", "b").agg(F.count(F.lit(1)).alias("linhas"))


def _cast_audit(book: Book, columns: list[tuple[str, str]], cast: Callable[[Column], Column]) -> DataFrame:
    """Every distinct text of some raw columns with its value and frequency."""
    texts = [
        book.raw[table].select(F.lit(name).alias("coluna"), casting.trimmed(name).alias("texto"))
        for table, name in columns
    ]
    counted = (
        reduce(DataFrame.unionByName, texts)
        .groupBy("coluna", "texto")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )
    return counted.withColumn("valor", cast(F.col("texto")))


DATE_TEXTS = [
    ("customers", "data_nascimento"),
    ("customers", "data_cadastro"),
    ("loans", "data_concessao"),
    ("payments", "data_vencimento"),
    ("payments", "data_pagamento"),
]
DOUBLE_TEXTS = [
    ("customers", "renda_mensal"),
    ("customers", "score_interno"),
    ("loans", "valor_contratado"),
    ("loans", "taxa_juros_anual"),
    ("payments", "valor_parcela"),
    ("payments", "valor_pago"),
]
INT_TEXTS = [("loans", "prazo_meses"), ("payments", "atraso_dias")]


def theoretical_pmt(book: Book) -> DataFrame:
    names = ["loan_id", "valor_contratado", "prazo_meses", "taxa_anual_decimal", "pmt_teorica"]
    return rounded(book.loans.select(names))


# --- installments ------------------------------------------------------------


def installment_payments(book: Book) -> DataFrame:
    matched = schedule.match_payments(book.loans.select(schedule.SCHEDULE_COLUMNS[:-2]), book.payments)
    return rounded(matched)


def installment_amounts(book: Book) -> DataFrame:
    names = ["loan_id", "numero_parcela", "valor_devido", "valor_pago", "valor_em_aberto"]
    return rounded(book.installments.select(names))


def installment_status(book: Book) -> DataFrame:
    grouped = book.installments.groupBy("status_parcela", "dq_parcela_sem_registro_pagamento")
    return grouped.agg(F.count(F.lit(1)).alias("parcelas"))


def installment_dpd(book: Book) -> DataFrame:
    grouped = book.installments.groupBy("status_parcela", "dpd_efetivo")
    return grouped.agg(F.count(F.lit(1)).alias("parcelas"))


def enriched_installments(book: Book) -> DataFrame:
    mart = book.installment_mart
    grouped = mart.groupBy("canal", "estado", "status_parcela").agg(
        F.count(F.lit(1)).alias("parcelas"),
        F.count("nome").alias("com_cliente"),
        F.sum(F.col("valor_em_aberto").cast("decimal(18,3)")).cast("double").alias("valor_em_aberto"),
    )
    return rounded(grouped, 3)


def loan_open_balance(book: Book) -> DataFrame:
    return rounded(performance.loan_totals(book.installments), 4)


def derived_status_matrix(book: Book) -> DataFrame:
    grouped = book.performance.groupBy("status_reportado", "status_derivado", "dq_status_divergente")
    return grouped.agg(F.count(F.lit(1)).alias("contratos"))


# --- indicators --------------------------------------------------------------


def _kpi_rounded(rows: DataFrame) -> DataFrame:
    """Amounts to cents, shares to nine digits."""
    is_share = F.col("kpi_nome").startswith("par") == F.lit(False)
    value = F.when(is_share, F.round("kpi_valor", 9)).otherwise(F.round("kpi_valor", 2))
    return rows.withColumn("kpi_valor", value)


def _single_kpi(make: Callable[[Book], DataFrame], name: str) -> Callable[[Book], DataFrame]:
    return lambda book: _kpi_rounded(make(book).where(F.col("kpi_nome") == name))


def _installment_kpis(book: Book) -> DataFrame:
    return kpis.installment_kpis(book.installments, book.snapshot.reference)


def _loan_kpis(book: Book) -> DataFrame:
    return kpis.loan_kpis(book.performance, book.snapshot.reference)


def _customer_kpis(book: Book) -> DataFrame:
    return kpis.customer_kpis(book.loans, book.snapshot.reference)


def vintage_ages(book: Book) -> DataFrame:
    first = vintage.first_defaults(book.loans, book.installments, book.snapshot.reference)
    return vintage.vintage_curve(first, book.snapshot.reference)


# --- quality and profiles ----------------------------------------------------


def dq_derived(book: Book) -> DataFrame:
    # the loan table reads installments too, and matching them costs far more
    installments = tables.staged(book.installments.select(performance.TOTALLED_COLUMNS), "installments")
    of_loans = gold.int_loan_performance(book.cleaned["loans"], installments, book.snapshot)
    flagged = {
        "int_installments": checks.count_flags(installments, ["dq_parcela_sem_registro_pagamento"]),
        "int_loan_performance": checks.count_flags(of_loans, ["dq_status_divergente"]),
        "raw_loans": checks.count_flags(
            book.raw["loans"].select(bronze.padded("prazo_meses").alias("prazo_meses_com_espaco")),
            ["prazo_meses_com_espaco"],
        ),
    }
    return profile.labelled(flagged)


def _checked_tables(book: Book, names: Iterable[str]) -> dict[str, DataFrame]:
    made = {
        "stg_customers": lambda: book.customers,
        "stg_loans": lambda: book.loans,
        "stg_payments": lambda: book.payments,
        "int_installments": lambda: book.installments,
        "int_loan_performance": lambda: book.performance,
        "mart_credit_installments": lambda: book.installment_mart,
        "mart_credit_loans": lambda: book.loan_mart,
        "mart_kpis_daily": lambda: book.daily_kpis,
        "mart_kpis_vintage": lambda: book.vintage_kpis,
    }
    return {name: made[name]() for name in names}


def _cleaned(book: Book) -> dict[str, DataFrame]:
    """The cleaned tables with their data columns only."""
    all_tables = {"customers": book.customers, "loans": book.loans, "payments": book.payments}
    return {
        name: rows.select([column for column in rows.columns if not column.startswith("dq_")])
        for name, rows in all_tables.items()
    }


NULL_COUNTED = {
    "customers": ["data_nascimento", "data_cadastro"],
    "loans": ["data_concessao"],
    "payments": ["data_vencimento", "data_pagamento"],
}
DESCRIBED = {
    "customers": ["renda_mensal", "score_interno"],
    "loans": ["valor_contratado", "prazo_meses", "taxa_juros_anual"],
    "payments": ["valor_parcela", "valor_pago", "atraso_dias"],
}
DISTINCT_COLUMNS = [
    ("customers", "customer_id"),
    ("customers", "nome"),
    ("loans", "loan_id"),
    ("loans", "customer_id"),
    ("payments", "payment_id"),
    ("payments", "loan_id"),
]
COUNTED = [("customers", "estado"), ("loans", "canal"), ("loans", "status_reportado")]


def profile_nonnull(book: Book) -> DataFrame:
    return profile.labelled({name: profile.column_info(rows) for name, rows in _cleaned(book).items()})


def profile_nulls(book: Book) -> DataFrame:
    cleaned = _cleaned(book)
    return profile.labelled(
        {name: profile.null_counts(cleaned[name], columns) for name, columns in NULL_COUNTED.items()}
    )


def profile_describe(book: Book) -> DataFrame:
    cleaned = _cleaned(book)
    described = {name: profile.describe(cleaned[name], columns) for name, columns in DESCRIBED.items()}
    return rounded(profile.labelled(described), 4)


def _shown(book: Book, rows_of: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """Some rows of each cleaned table, one row per field, amounts to a hundredth
    of a cent."""
    parts = []
    for name, rows in _cleaned(book).items():
        shown = rows_of(rows, KEYS[name])
        texts = {
            column: F.col(column).cast("decimal(20,4)" if kind == "double" else "string").cast("string")
            for column, kind in shown.dtypes
        }
        fields = [F.struct(F.lit(column).alias("coluna"), text.alias("valor")) for column, text in texts.items()]
        parts.append(
            shown.select(F.lit(name).alias("tabela"), F.col(KEYS[name][0]).alias("chave"), F.inline(F.array(*fields)))
        )
    return reduce(DataFrame.unionByName, parts)


def profile_head(book: Book) -> DataFrame:
    return _shown(book, profile.head)


def profile_tail(book: Book) -> DataFrame:
    return _shown(book, profile.tail)


def profile_distinct(book: Book) -> DataFrame:
    cleaned = _cleaned(book)
    parts = [
        profile.distinct_values(cleaned[table], column).select(
            F.lit(table).alias("tabela"), F.lit(column).alias("coluna"), F.col(column).alias("valor")
        )
        for table, column in DISTINCT_COLUMNS
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_value_counts(book: Book) -> DataFrame:
    cleaned = _cleaned(book)
    parts = [
        profile.value_counts(cleaned[table], column).select(
            F.lit(table).alias("tabela"), F.lit(column).alias("coluna"), "valor", "frequencia"
        )
        for table, column in COUNTED
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_top_values(book: Book) -> DataFrame:
    parts = [
        profile.top_values(book.cleaned[table], column, TOP_VALUES).select(
            F.lit(table).alias("tabela"),
            F.lit(column).alias("coluna"),
            F.col("valor").cast("string").alias("valor"),
            "frequencia",
        )
        for table, column in TOP_COLUMNS
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Callable[[Book], DataFrame]] = {
    "csv_text_source": csv_text_source,
    "csv_typed_source": csv_typed_source,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_partition_counts": bronze_partition_counts,
    "incremental_upsert": incremental_upsert,
    "export_readback": export_readback,
    "full_refresh": full_refresh,
    "normalize_text": normalize_text,
    "normalize_case": normalize_case,
    "safe_cast_date": lambda book: _cast_audit(book, DATE_TEXTS, casting.safe_date),
    "safe_cast_double": lambda book: _cast_audit(book, DOUBLE_TEXTS, casting.safe_double),
    "safe_cast_int": lambda book: _cast_audit(book, INT_TEXTS, casting.safe_int),
    "visible_payments": lambda book: silver.visible_payments(book.raw["payments"], book.snapshot),
    "latest_customers": lambda book: _cleaned(book)["customers"],
    "latest_loans": lambda book: _cleaned(book)["loans"].drop("taxa_anual_decimal", "pmt_teorica"),
    "latest_payments": lambda book: _cleaned(book)["payments"],
    "stg_customers": lambda book: book.customers,
    "stg_loans": lambda book: rounded(book.loans),
    "stg_payments": lambda book: book.payments,
    "theoretical_pmt": theoretical_pmt,
    "installment_schedule": lambda book: rounded(schedule.installment_schedule(book.loans)),
    "installment_payments": installment_payments,
    "installment_amounts": installment_amounts,
    "installment_status": installment_status,
    "installment_dpd": installment_dpd,
    "int_installments": lambda book: rounded(book.installments),
    "enriched_installments": enriched_installments,
    "loan_open_balance": loan_open_balance,
    "loan_performance": lambda book: rounded(book.performance, 4),
    "derived_status_matrix": derived_status_matrix,
    "customer_contract_stats": lambda book: performance.customer_contracts(book.loans),
    "mart_credit_installments": lambda book: rounded(book.installment_mart),
    "mart_credit_loans": lambda book: rounded(book.loan_mart, 4),
    "mart_kpis_daily": lambda book: _kpi_rounded(book.daily_kpis),
    "kpis_backfill": kpis_backfill,
    "kpi_default_rate": _single_kpi(_loan_kpis, "taxa_inadimplencia_contratos"),
    "kpi_par30": _single_kpi(_installment_kpis, "par30_valor_em_aberto"),
    "kpi_par90": _single_kpi(_installment_kpis, "par90_valor_em_aberto"),
    "kpi_multi_contract": _single_kpi(_customer_kpis, "pct_clientes_multiplos_contratos"),
    "kpi_yield": _single_kpi(_installment_kpis, "yield_efetivo_aprox"),
    "kpi_on_time": _single_kpi(_installment_kpis, "pct_parcelas_pagas_em_dia"),
    "installment_default_date": lambda book: vintage.installment_defaults(
        book.installments, book.snapshot.reference
    ),
    "first_default_date": lambda book: vintage.first_defaults(
        book.loans, book.installments, book.snapshot.reference
    ),
    "vintage_ages": vintage_ages,
    "mart_kpis_vintage": lambda book: rounded(book.vintage_kpis, 9),
    "default_rate_90": lambda book: rounded(adhoc.default_rate_90(book.performance), 9),
    "par_ratios": lambda book: rounded(adhoc.par_ratios(book.performance), 9),
    "origination_vintage": lambda book: rounded(adhoc.origination_vintage(book.performance), 9),
    "recurring_customer_share": lambda book: rounded(
        adhoc.recurring_customer_share(book.loan_mart), 9
    ),
    "dq_customers": lambda book: checks.count_flags(book.customers, list(customer_flags())),
    "dq_loans": lambda book: checks.count_flags(book.loans, list(loan_flags())),
    "dq_payments": lambda book: checks.count_flags(book.payments, list(payment_flags())),
    "dq_derived": dq_derived,
    "check_not_null": lambda book: checks.check_not_null(_checked_tables(StoredBook.of(book), c.NOT_NULL)),
    "check_unique": lambda book: checks.check_unique(_checked_tables(KeyedBook.of(book), c.UNIQUE)),
    "repeated_installments": lambda book: checks.repeated_installments(book.installments),
    "profile_nonnull": profile_nonnull,
    "profile_head": profile_head,
    "profile_tail": profile_tail,
    "profile_distinct": profile_distinct,
    "profile_nulls": profile_nulls,
    "profile_describe": profile_describe,
    "profile_value_counts": profile_value_counts,
    "profile_top_values": profile_top_values,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, _make=make: _make(Book(spark, sf_dir)))
        for name, make in QUERIES.items()
    }

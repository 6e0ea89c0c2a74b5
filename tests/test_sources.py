import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from loanbook import Snapshot
from loanbook import contract as c
from loanbook.plans import run
from loanbook.sources import bronze, csv_files, tables

LOANS = (
    "loan_id,customer_id,data_concessao,valor_contratado,prazo_meses,taxa_juros_anual,canal,status\n"
    'L1,C1,2024-01-01,1200, 12 ,0,"App ""x"", y",ativo\n'
    "L2,NA,2024-02-01,,3,NULL,loja,\n"
    "L3,C2,2024-03-01,100,1\n"
)
CUSTOMERS = (
    "customer_id,nome,data_nascimento,renda_mensal,score_interno,estado,data_cadastro\n"
    "C1,Ana,1990-01-01,1000,500,sp,2020-01-01\nC2,Bia,,n/a,,XXX,2020-01-01\n"
)
PAYMENTS = (
    "payment_id,loan_id,data_vencimento,data_pagamento,valor_parcela,valor_pago,atraso_dias\n"
    "P1,L1,2024-01-31,2024-01-31,100,100,0\nP2,L1,2024-03-01,2024-07-01,100,100,122\n"
)


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_text_csv_keeps_every_text(spark, tmp_path):
    rows = csv_files.read_text_csv(spark, put(tmp_path, "loans.csv", LOANS)).collect()
    assert rows[0].prazo_meses == " 12 " and rows[0].canal == 'App "x", y'
    assert rows[1].customer_id == "NA" and rows[1].valor_contratado == "" and rows[1].taxa_juros_anual == "NULL"
    assert (rows[2].taxa_juros_anual, rows[2].canal, rows[2].status) == ("", "", "")


def test_quoted_line_breaks_are_found_and_kept(spark, tmp_path):
    text = 'a,b\n1,"two\nlines"\n2,"say ""hi"""\n'
    broken = put(tmp_path, "broken.csv", text)
    plain = put(tmp_path, "plain.csv", 'a,b\n1,"x ""y"" z"\n')
    assert csv_files.has_quoted_line_breaks(spark, broken)
    assert not csv_files.has_quoted_line_breaks(spark, plain)
    rows = csv_files.read_text_csv(spark, broken).orderBy("a").collect()
    assert [tuple(row) for row in rows] == [("1", "two\nlines"), ("2", 'say "hi"')]


def test_awkward_values_survive_export(spark, tmp_path):
    values = ['a"b', " pad ", "x,y", '"quoted"', "two\nlines", "\ttab", "back\\slash", '\\"', "it's"]
    rows = spark.createDataFrame(list(enumerate(values)), "n int, text string")
    tables.export_csv(rows, str(tmp_path / "out"))
    read = csv_files.read_typed_csv(spark, str(tmp_path / "out"), {"n": "int"})
    assert sorted(tuple(row) for row in read.collect()) == list(enumerate(values))


@pytest.mark.parametrize("line", ["3,4,5", "7,8,", '"1,2",3,"4"'])
def test_too_many_fields_raise(spark, tmp_path, line):
    path = put(tmp_path, "wide.csv", f"a,b\n1,2\n{line}\n9\n")
    with pytest.raises(csv_files.TooManyFields, match="1 records"):
        csv_files.read_text_csv(spark, path)


def test_too_many_fields_raise_over_lines(spark, tmp_path):
    path = put(tmp_path, "wide.csv", 'a,b\n1,"x\ny",3\n4,"p\nq"\n')
    with pytest.raises(csv_files.TooManyFields, match="1 records"):
        csv_files.read_text_csv(spark, path)


def test_commas_in_quotes_are_no_fields(spark, tmp_path):
    rows = csv_files.read_text_csv(spark, put(tmp_path, "ok.csv", 'a,b\n"1,2,3","x,""y"",z"\n4\n')).collect()
    assert [tuple(row) for row in rows] == [("1,2,3", 'x,"y",z'), ("4", "")]


def test_a_stray_quote_keeps_the_file_split(spark, tmp_path):
    lines = "".join(f"{i},plain text of line {i}\n" for i in range(4000))
    path = put(tmp_path, "stray.csv", 'a,b\n0,5" tape\n' + lines)
    assert not csv_files.has_quoted_line_breaks(spark, path)
    limits = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in limits}
    for name in limits:
        spark.conf.set(name, "16384")
    try:
        rows = csv_files.read_text_csv(spark, path)
        assert rows.rdd.getNumPartitions() > 4
        assert rows.count() == 4001 and rows.where("b = '5\" tape'").count() == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_typed_csv(spark, tmp_path):
    types = {"data_concessao": "date", "prazo_meses": "int", "valor_contratado": "double"}
    rows = csv_files.read_typed_csv(spark, put(tmp_path, "loans.csv", LOANS), types).collect()
    assert rows[0].prazo_meses == 12 and rows[0].data_concessao == dt.date(2024, 1, 1)
    assert rows[1].valor_contratado is None and rows[1].status is None


def test_bronze_rerun_replaces_its_day_only(spark, tmp_path):
    base = str(tmp_path / "bronze")
    first = spark.createDataFrame([("a",), ("b",)], "x string")
    second = spark.createDataFrame([("c",)], "x string")
    bronze.write_bronze(first, base, "loans", "2024-01-01")
    bronze.write_bronze(first, base, "loans", "2024-01-02")
    bronze.write_bronze(second, base, "loans", "2024-01-01")
    rows = bronze.read_bronze(spark, base, "loans_raw")
    assert dict(rows.dtypes)["ingestion_date"] == "date"
    assert sorted((row.x, str(row.ingestion_date)) for row in rows.collect()) == [
        ("a", "2024-01-02"),
        ("b", "2024-01-02"),
        ("c", "2024-01-01"),
    ]


def test_bronze_rerun_without_rows_empties_its_day(spark, tmp_path):
    base = str(tmp_path / "bronze")
    rows = spark.createDataFrame([("a",)], "x string")
    bronze.write_bronze(rows, base, "loans", "2024-01-01")
    bronze.write_bronze(rows, base, "loans", "2024-01-02")
    bronze.write_bronze(rows.where("x = 'none'"), base, "loans", "2024-01-01")
    left = bronze.read_bronze(spark, base, "loans").collect()
    assert [(row.x, str(row.ingestion_date)) for row in left] == [("a", "2024-01-02")]


def failing(rows):
    """The rows with a column value that cannot be computed."""
    broken = F.when(F.col(rows.columns[-1]).isNotNull(), F.raise_error(F.lit("broken"))).cast("string")
    return rows.withColumn(rows.columns[-1], broken)


def test_a_failed_job_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "x string, y string")
    tables.write_table(rows, path)
    with pytest.raises(Exception, match="broken"):
        tables.write_table(failing(rows), path)
    assert sorted(tuple(row) for row in tables.read_table(spark, path).collect()) == [("a", "1"), ("b", "2")]
    assert [entry.name for entry in tmp_path.iterdir()] == ["table"]


def test_a_failed_upsert_leaves_every_snapshot(spark, tmp_path):
    path = str(tmp_path / "kpis")
    tables.upsert(kpi_rows(spark, "2024-01-01", {"a": 1.0, "b": 2.0}), path, c.DAILY_KEYS)
    before = stored(tables.read_table(spark, path))
    with pytest.raises(Exception, match="broken"):
        tables.upsert(failing(kpi_rows(spark, "2024-01-01", {"a": 9.0})), path, c.DAILY_KEYS)
    assert stored(tables.read_table(spark, path)) == before
    assert [entry.name for entry in tmp_path.iterdir()] == ["kpis"]


def test_a_failed_refresh_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    inputs, lake = tmp_path / "in", str(tmp_path / "lake")
    inputs.mkdir()
    for name, text in (("customers", CUSTOMERS), ("loans", LOANS), ("payments", PAYMENTS)):
        put(inputs, f"{name}.csv", text)
    run.run(spark, str(inputs), lake, str(tmp_path / "out"), Snapshot("2024-12-31", "2024-12-31"), "2024-01-01")
    before = spark.read.parquet(f"{lake}/gold/mart_credit_loans").orderBy("loan_id").collect()
    made = run.gold.mart_credit_loans
    monkeypatch.setattr(run.gold, "mart_credit_loans", lambda rows: failing(made(rows)))
    with pytest.raises(Exception, match="broken"):
        run.refresh(spark, lake, Snapshot("2024-06-30", "2024-06-30"))
    assert spark.read.parquet(f"{lake}/gold/mart_credit_loans").orderBy("loan_id").collect() == before


def test_the_job_entry(spark, tmp_path):
    from loanbook import __main__ as job

    inputs = tmp_path / "in"
    inputs.mkdir()
    for name, text in (("customers", CUSTOMERS), ("loans", LOANS), ("payments", PAYMENTS)):
        put(inputs, f"{name}.csv", text)
    given = ["--input", str(inputs), "--lake", str(tmp_path / "lake"), "--output", str(tmp_path / "out")]
    dates = ["--ingestion-date", "2024-01-01", "--data-referencia", "2024-12-31", "--data-corte", "2024-12-31"]
    job.main([*given, *dates, "--fail-on-violation"])
    found = {name: spark.read.csv(f"{tmp_path}/out/{name}", header=True).count() for name in run.EXPORTED}
    assert set(found) == set(run.EXPORTED) and found["mart_credit_loans"] == 3


def test_later_partitions_are_not_read(spark, tmp_path):
    from loanbook.plans import silver

    base = str(tmp_path / "bronze")
    rows = spark.createDataFrame([("P1", "L1", "2024-01-31", "", "1", "1", "0")], c.RAW_COLUMNS["payments"])
    for day in ("2024-01-01", "2024-01-02"):
        bronze.write_bronze(rows, base, "payments", day)
    seen = silver.visible_payments(bronze.read_bronze(spark, base, "payments"), Snapshot("2024-01-01"))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert seen.count() == 1


def test_ingest_stops_at_the_missing_file(spark, tmp_path):
    put(tmp_path, "customers.csv", CUSTOMERS)
    base = str(tmp_path / "bronze")
    with pytest.raises(bronze.MissingInput, match="loans.csv"):
        bronze.ingest(spark, str(tmp_path), base, "2024-01-01")
    assert bronze.exists(spark, f"{base}/customers") and not bronze.exists(spark, f"{base}/loans")


def kpi_rows(spark, day, values):
    return spark.createDataFrame(
        [(dt.date.fromisoformat(day) if day else None, name, value, "d") for name, value in values.items()],
        "data_referencia date, kpi_nome string, kpi_valor double, kpi_descricao string",
    )


def stored(rows):
    return sorted(
        (str(row.data_referencia), row.kpi_nome, row.kpi_valor) for row in rows.collect()
    )


def test_upsert_replaces_keys_and_keeps_the_rest(spark, tmp_path):
    path = str(tmp_path / "kpis")
    keys = c.DAILY_KEYS
    tables.upsert(kpi_rows(spark, "2024-01-01", {"a": 1.0, "gone": 2.0}), path, keys)
    tables.upsert(kpi_rows(spark, "2024-01-02", {"a": 3.0}), path, keys)
    again = kpi_rows(spark, "2024-01-01", {"a": 4.0, "new": 5.0})
    expected = [
        ("2024-01-01", "a", 4.0),
        ("2024-01-01", "gone", 2.0),
        ("2024-01-01", "new", 5.0),
        ("2024-01-02", "a", 3.0),
    ]
    assert stored(tables.upsert(again, path, keys)) == expected
    assert stored(tables.upsert(again, path, keys)) == expected


def test_upsert_of_undated_rows_appends(spark, tmp_path):
    path = str(tmp_path / "kpis")
    tables.upsert(kpi_rows(spark, "2024-01-01", {"a": 1.0}), path, c.DAILY_KEYS)
    for _ in range(2):
        result = tables.upsert(kpi_rows(spark, None, {"a": 2.0}), path, c.DAILY_KEYS)
    assert stored(result) == [("2024-01-01", "a", 1.0), ("None", "a", 2.0), ("None", "a", 2.0)]


def test_full_run_and_backfill(spark, tmp_path):
    inputs = tmp_path / "in"
    inputs.mkdir()
    for name, text in (("customers", CUSTOMERS), ("loans", LOANS), ("payments", PAYMENTS)):
        put(inputs, f"{name}.csv", text)
    lake, output = str(tmp_path / "lake"), str(tmp_path / "out")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        run.run(spark, str(inputs), lake, output, Snapshot("2024-12-31", "2024-12-31"), "2024-01-01")
    assert any("prazo_meses" in str(warning.message) for warning in caught)

    def daily():
        rows = spark.read.parquet(f"{lake}/gold/mart_kpis_daily")
        return sorted((str(r.data_referencia), r.kpi_nome, r.kpi_valor) for r in rows.collect())

    first = daily()
    assert len(first) == 6 and len(first[0]) == 3
    run.refresh(spark, lake, Snapshot("2024-06-30", "2024-06-30"))
    assert len(daily()) == 12
    result = run.refresh(spark, lake, Snapshot("2024-12-31", "2024-12-31"))
    assert [row for row in daily() if row[0] == "2024-12-31"] == first
    assert len(daily()) == 12
    assert result["mart_kpis_vintage"].where("data_referencia = date'2024-12-31'").count() == 36
    assert result["mart_credit_installments"].count() == 16
    checked = {(r.tabela, r.coluna, r.teste): r.violacoes for r in run.check(result).collect()}
    assert len(checked) == 21 and set(checked.values()) == {0}
    exported = spark.read.csv(f"{output}/mart_credit_loans", header=True)
    assert exported.columns == result["mart_credit_loans"].columns and exported.count() == 3


def test_loss_of_work_is_bounded_by_stored_tables(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    rows = tables.staged(spark.range(3).select(F.col("id")), "ids")
    assert all(name.removeprefix("file://").removeprefix("file:").startswith(root) for name in rows.inputFiles())

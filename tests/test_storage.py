"""Work that is stored once for its several readers."""

import glob

from pyspark.sql import functions as F

from loanbook import contract as c
from loanbook.catalog import queries
from loanbook.sources import bronze, csv_files, tables

SF_DIR = "/root/testdata/sf0.001"


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString().lower()


def test_spanning_records_are_parsed_once(spark, tmp_path):
    (tmp_path / "some.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    rows = csv_files.read_text_csv(spark, str(tmp_path / "some.csv"))
    assert "csv" not in plan(rows).replace("csv-rows", "") and "mapinarrow" not in plan(rows)
    assert sorted(map(tuple, rows.collect())) == [("1", "x\ny"), ("2", "z")]


def test_days_written_at_once(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", "2000-01-01"), ("2", "2000-01-02"), ("2", "2000-01-02"), (None, "2000-01-02"), ("4", "2000-01-04"), ("5", None)],
        f"a string, {c.INGESTION_COLUMN} string",
    )
    days, once, singly = ["2000-01-01", "2000-01-02", "2000-01-03"], str(tmp_path / "once"), str(tmp_path / "singly")
    for day in days:
        bronze.write_bronze(raw.where(F.col(c.INGESTION_COLUMN) == day), singly, "t", day)
    # the third day held rows; it is replaced by nothing, as a rerun does
    bronze.write_bronze(raw.select("a"), once, "t", days[2])
    bronze.write_bronze_days(raw, once, "t", days)
    found, expected = (sorted(map(str, bronze.read_bronze(spark, base, "t").collect())) for base in (once, singly))
    assert found == expected and len(found) == 4
    assert not glob.glob(f"{once}/_*")


def test_another_snapshot_shares_customers_and_loans(spark):
    earlier = queries.Book(spark, SF_DIR, queries.EARLIER)
    later = earlier.of_snapshot(queries.SNAPSHOT)
    assert later.cleaned["loans"] is earlier.cleaned["loans"] and later.cleaned["customers"] is earlier.cleaned["customers"]
    expected = queries.Book(spark, SF_DIR, queries.SNAPSHOT)
    for book in (later, expected):
        assert "payment_id" not in book.cleaned["payments"].columns
    found, expected = (sorted(map(str, queries._kpi_rounded(book.daily_kpis).collect())) for book in (later, expected))
    assert found == expected and len(found) == 6


def test_many_dates_match_payments_once(spark):
    rows = queries.kpis_backfill(queries.Book(spark, SF_DIR))
    assert "row_number" not in plan(rows) and "lead(" not in plan(rows)


def test_stored_tables_are_compressed_well(spark, tmp_path):
    tables.write_table(spark.range(9), str(tmp_path / "t"))
    assert glob.glob(f"{tmp_path}/t/*.zstd.parquet")
    assert all(name.endswith(".zstd.parquet") for name in tables.staged(spark.range(9), "t").inputFiles())


def _stored_by(monkeypatch, job):
    """Names and columns of the tables a query stores."""
    stored = []
    staged = tables.staged
    monkeypatch.setattr(tables, "staged", lambda rows, name: stored.append((name, set(rows.columns))) or staged(rows, name))
    job()
    return stored


def test_flag_counts_match_payments_once(spark, monkeypatch):
    plans = []
    stored = _stored_by(monkeypatch, lambda: plans.append(plan(queries.dq_derived(queries.Book(spark, SF_DIR)))))
    assert sorted(name for name, _ in stored) == ["installments", "loans", "payments"]
    assert "bit_or" not in plans[0]


def test_checks_store_what_they_read(spark, monkeypatch):
    stored = dict(_stored_by(monkeypatch, lambda: queries.QUERIES["check_not_null"](queries.Book(spark, SF_DIR))))
    assert "data_ingestao" not in stored["payments"] and not any(name.startswith("dq_") for name in stored["payments"])
    assert stored["installments"] == set(queries.READ_OF_INSTALLMENTS)


def test_unique_keys_need_no_stored_installments(spark, monkeypatch):
    stored = _stored_by(monkeypatch, lambda: queries.QUERIES["check_unique"](queries.Book(spark, SF_DIR)))
    assert sorted(name for name, _ in stored) == ["customers", "loans", "payments", "performance"]


def test_loan_table_stores_no_payments(spark, monkeypatch):
    """Both steps of the match read the shuffle of the latest-row step."""
    marts = []
    stored = _stored_by(monkeypatch, lambda: marts.append(queries.Book(spark, SF_DIR).loan_mart))
    assert [name for name, _ in stored] == ["loans"]
    book = queries.Book(spark, SF_DIR)
    expected = queries.gold.mart_credit_loans(book.performance)
    assert marts[0].dtypes == expected.dtypes
    found, expected = (sorted(map(str, queries.rounded(rows).collect())) for rows in (marts[0], expected))
    assert found == expected and found


def test_installment_table_describes_loans_once(spark, monkeypatch):
    marts = []
    stored = _stored_by(monkeypatch, lambda: marts.append(queries.Book(spark, SF_DIR).installment_mart))
    assert [name for name, _ in stored] == ["described-loans"]
    cleaned = queries.Book(spark, SF_DIR).cleaned
    expected = queries.gold.mart_credit_installments(
        cleaned["loans"], cleaned["payments"], cleaned["customers"], queries.SNAPSHOT
    )
    assert marts[0].dtypes == expected.dtypes
    found, expected = (sorted(map(str, queries.rounded(rows).collect())) for rows in (marts[0], expected))
    assert found == expected and found


def test_phases_do_not_travel(spark):
    """The match adds a run to a loan and a cell to a payment, and no phase."""
    book = queries.Book(spark, SF_DIR)
    matched = queries.schedule.match_payments(book.loans, book.payments)
    text = matched._jdf.queryExecution().optimizedPlan().toString()
    assert "_phase" not in text and "_cell" in text


def test_shuffles_go_once_a_table_is_stored(spark, tmp_path, monkeypatch):
    """Each write runs with the setting, and leaves the session as it was."""
    from loanbook.sources import csv_files, folders, scratch

    def set_now():
        return spark.conf.get(scratch.SHUFFLES_GO, None)

    before, seen = set_now(), []
    write = type(spark.range(1)).write

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda rows: seen.append(set_now()) or write.fget(rows)))
    scratch.staged(spark.range(9), "t")
    tables.write_table(spark.range(9), str(tmp_path / "t"))
    csv_files.write_csv(spark.range(9), str(tmp_path / "c"))
    with folders.stored(spark.range(9), "s") as rows:
        path = rows.inputFiles()[0].rpartition("/")[0]
        assert rows.count() == 9 and folders.exists(spark, path)
    assert not folders.exists(spark, path)
    assert seen == ["true"] * 4 and set_now() == before


def test_stored_tables_are_matched_after_the_latest_rows(spark):
    """What the latest-row step shuffles is not there while payments are matched."""
    mart = queries.Book(spark, SF_DIR).installment_mart
    assert "row_number" not in plan(mart)


def test_tables_that_stay_hold_no_dictionaries(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(2000).selectExpr("cast(id as string) as text", "id * 0.5 as number", "date'2024-01-01' as ingestion_date")
    tables.write_table(rows, str(tmp_path / "t"))
    bronze.write_bronze_days(rows, str(tmp_path), "days", ["2024-01-01"])
    for path in glob.glob(f"{tmp_path}/**/*.parquet", recursive=True):
        group = pq.ParquetFile(path).metadata.row_group(0)
        assert not any(group.column(place).has_dictionary_page for place in range(group.num_columns))


def test_steps_of_a_refresh_go_on_at_once(spark, tmp_path, monkeypatch):
    """The cleaned tables are written together, the others after what they read."""
    import threading

    from loanbook import Snapshot
    from loanbook.plans import run

    for table, names in c.RAW_COLUMNS.items():
        empty = spark.createDataFrame([], ", ".join(f"{name} string" for name in names))
        bronze.write_bronze(empty, f"{tmp_path}/bronze", table, "2024-01-01")
    together, order = threading.Barrier(3, timeout=60), []
    write = tables.write_table

    def watched(rows, path):
        name = path.rpartition("/")[2]
        if name.startswith("stg_"):
            together.wait()
        order.append(name)
        return write(rows, path)

    monkeypatch.setattr(tables, "write_table", watched)
    stored = run.refresh(spark, str(tmp_path), Snapshot("2024-06-30", "2024-06-30"))
    assert sorted(order[:3]) == ["stg_customers", "stg_loans", "stg_payments"]
    assert order[3:] == ["loans_described", "mart_credit_installments", "mart_credit_loans"]
    assert all(rows.count() == 0 for name, rows in stored.items() if name != "mart_kpis_daily")

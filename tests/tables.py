"""Small raw tables for tests."""

from loanbook import contract as c


def raw(spark, table, rows):
    """A raw table from rows of texts, the ingestion date last."""
    columns = ", ".join(f"{name} string" for name in c.RAW_COLUMNS[table])
    return spark.createDataFrame(rows, f"{columns}, ingestion_date string").selectExpr(
        *c.RAW_COLUMNS[table], "cast(ingestion_date as date) as ingestion_date"
    )


def loan(key, granted="2024-01-01", amount="1200", term="12", rate="0", customer="C1", status="ativo", day="2024-01-01"):
    return (key, customer, granted, amount, term, rate, "app", status, day)


def payment(key, loan_key, due, paid_on=None, due_amount="100", paid="100", day="2024-01-01"):
    return (key, loan_key, due, paid_on, due_amount, paid, "0", day)


def customer(key, born="1990-01-01", income="1000", score="500", state="sp", day="2024-01-01"):
    return (key, f"nome {key}", born, income, score, state, "2020-01-01", day)

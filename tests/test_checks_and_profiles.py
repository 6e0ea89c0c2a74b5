import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanbook.operators import checks, profile, quantiles


def test_not_null_and_unique(spark):
    rows = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",)], "loan_id string")
    stored = {"mart_credit_loans": rows}
    nulls, repeats = checks.check_not_null(stored), checks.check_unique(stored)
    assert [tuple(row) for row in nulls.collect()] == [("mart_credit_loans", "loan_id", "not_null", 2)]
    assert [tuple(row) for row in repeats.collect()] == [("mart_credit_loans", "loan_id", "unique", 1)]
    with pytest.raises(checks.CheckFailed, match="mart_credit_loans.loan_id unique: 1"):
        checks.require_passed(nulls.unionByName(repeats))
    clean = {"mart_credit_loans": rows.where("loan_id = 'b'")}
    checks.require_passed(checks.check_not_null(clean).unionByName(checks.check_unique(clean)))


def test_flag_counts(spark):
    rows = spark.createDataFrame([(True, False), (True, True), (False, False)], "a boolean, b boolean")
    assert {tuple(row) for row in checks.count_flags(rows, ["a", "b"]).collect()} == {("a", 2), ("b", 1)}


@pytest.mark.parametrize("few", [quantiles.FEW_VALUES, 40])
def test_describe_matches_pandas(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW_VALUES", few)
    pick = random.Random(5)
    values = pd.DataFrame(
        {
            "smooth": [pick.gauss(0, 1) for _ in range(4000)],
            "heavy": [pick.choice([0.0, 0.0, 0.0, 1.0, pick.random()]) for _ in range(4000)],
            "whole": [float(pick.randrange(-5, 6)) for _ in range(4000)],
            "holes": [None if pick.random() < 0.3 else pick.random() for _ in range(4000)],
            "wide": [10 ** pick.uniform(-12, 12) for _ in range(4000)],
            "empty": [None] * 4000,
        }
    ).astype("float64")
    rows = spark.createDataFrame(
        [tuple(None if np.isnan(v) else float(v) for v in row) for row in values.to_numpy()],
        ", ".join(f"{name} double" for name in values.columns),
    )
    got = {row.coluna: row for row in profile.describe(rows, list(values.columns)).collect()}
    for name, want in values.describe().items():
        row = got[name]
        assert row.contagem == want["count"]
        if not row.contagem:
            assert row.q50 is None and row.media is None
            continue
        assert row.media == pytest.approx(want["mean"])
        assert row.desvio == pytest.approx(want["std"])
        assert (row.minimo, row.maximo) == (want["min"], want["max"])
        assert (row.q25, row.q50, row.q75) == pytest.approx((want["25%"], want["50%"], want["75%"]), rel=1e-12)


def test_nan_counts_as_missing(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    row = profile.describe(rows, ["x"]).first()
    assert (row.contagem, row.q50, row.maximo) == (2, 2.0, 3.0)


def test_profiles(spark):
    rows = spark.createDataFrame(
        [(1, "b"), (2, "a"), (3, "b"), (4, None), (5, "c"), (6, "b"), (7, "a")], "k int, v string"
    )
    info = {(row.coluna, row.tipo, row.nao_nulos) for row in profile.column_info(rows).collect()}
    assert info == {("k", "int", 7), ("v", "string", 6)}
    assert [row.k for row in profile.head(rows, ["k"]).collect()] == [1, 2, 3, 4, 5]
    assert [row.k for row in profile.tail(rows, ["k"]).collect()] == [7, 6, 5, 4, 3]
    assert {row.v for row in profile.distinct_values(rows, "v").collect()} == {"a", "b", "c", None}
    assert [tuple(row) for row in profile.value_counts(rows, "v").collect()] == [("b", 3), ("a", 2), ("c", 1)]
    assert [tuple(row) for row in profile.null_counts(rows, ["k", "v"]).collect()] == [("k", 0), ("v", 1)]


@pytest.mark.parametrize("buckets", [1, 5, 64, profile.BUCKETS])
def test_top_values_are_the_first_of_all(spark, buckets):
    draw = random.Random(buckets)
    texts = [f"v{int(draw.paretovariate(0.7)) % 4000}" for _ in range(5000)] + [None] * 900
    rows = spark.createDataFrame([(text,) for text in texts], "text string")
    everything = [tuple(row) for row in profile.value_counts(rows, "text").collect()]
    for n in (1, 7, 40, len(everything) + 3):
        found = [tuple(row) for row in profile.top_values(rows, "text", n, buckets).collect()]
        assert found == everything[:n]


def test_top_values_of_ties_zeros_and_nothing(spark):
    ties = spark.createDataFrame([(f"{i:03}",) for i in range(300)], "text string")
    assert [row.valor for row in profile.top_values(ties, "text", 3).collect()] == ["000", "001", "002"]
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (1.0,), (0.0,)], "x double")
    assert [tuple(row) for row in profile.top_values(zeros, "x", 1).collect()] == [(0.0, 3)]
    assert profile.top_values(ties.where("text is null"), "text", 3).collect() == []


def test_top_values_count_few_values_in_full(spark):
    """Only buckets that could hold one of the first values are counted."""
    rows = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, F.lit(-1)).otherwise(F.col("id")).alias("x"))
    hot = rows.unionByName(spark.range(3000).select((F.col("id") % 3 - 9).alias("x")))
    top = profile.top_values(hot, "x", 4)
    assert [tuple(row) for row in top.collect()] == [(-1, 50_000), (-9, 1000), (-8, 1000), (-7, 1000)]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "_rows#" in plan and ">= 1000" in plan


@pytest.mark.parametrize("few", [quantiles.FEW_VALUES, 40])
def test_quantiles_share_sketches_and_scans(spark, monkeypatch, few):
    """Ranks of the same window are measured, narrowed and counted out together."""
    monkeypatch.setattr(quantiles, "FEW_VALUES", few)
    asked = {"percentile_approx": [], "count_if": []}
    for name, calls in asked.items():
        made = getattr(F, name)
        monkeypatch.setattr(quantiles.F, name, lambda *a, made=made, calls=calls: calls.append(a) or made(*a))
    rows = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).cast("double").alias("x"), F.lit(1.0).alias("y"))
    found = quantiles.exact_quantiles(rows, ["x", "y"], [0.25, 0.5, 0.75])
    assert found == {"x": [4999.75, 9999.5, 14999.25], "y": [1.0, 1.0, 1.0]}
    windows = [str(value) for value, *_ in asked["percentile_approx"]]
    assert len(windows) == len(set(windows)) and len(windows) < 12
    assert len(asked["count_if"]) <= 6 * 4


def test_values_are_counted_out_in_one_pass(spark):
    rows = spark.createDataFrame([(float(i % 9), float(i % 4), None if i % 2 else 1.0) for i in range(100)], "a double, b double, c double")
    searches = {i: quantiles._Search(column, rank, 100) for i, (column, rank) in enumerate([("a", 3), ("a", 98), ("b", 50), ("c", 49)])}
    scanned = []
    class Watched:
        def __getattr__(self, name):
            scanned.append(name)
            return getattr(rows, name)
    assert quantiles._count_out(Watched(), searches) == {0: 0.0, 1: 8.0, 2: 2.0, 3: 1.0}
    assert len(scanned) == 1

"""Hard negatives against scoring every pair in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanbook.llm import hard_negatives as hard


def expected(rows, positives=5, negatives=10, low=30, high=90):
    """Rows of (id, label, anchor, vector), repeated ones once."""
    found, rows = [], sorted(set(rows))
    for anchor_id, label, anchor, vector in rows:
        if not anchor:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, other)), key, own)
            for key, own, _, other in rows
            if key != anchor_id and len(other) == len(vector)
        ]
        scored.sort()
        own = [(-score, key) for score, key, other in scored if other == label][:positives]
        for positive, positive_id in own:
            fits = [(-s, key) for s, key, other in scored if other != label and low * positive <= -100 * s <= high * positive]
            found += [(anchor_id, positive_id, rank, key, positive, s) for rank, (s, key) in enumerate(fits[:negatives], 1)]
    return sorted(found)


def mined(spark, rows, **limits):
    frame = spark.createDataFrame(rows, "vec_id long, label long, anchor boolean, vector array<long>")
    return sorted(tuple(row) for row in hard.mine(frame, **limits).collect())


def clustered(seed, number, size, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    vectors = [(centres[i % 6] + spread * rng.normal(size=size)) * 40 for i in range(number)]
    return [(i, int(rng.integers(0, 4)), i % 10 == 0, tuple(int(math.floor(x)) for x in v)) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("size, spread", [(3, 0.5), (64, 0.3), (100, 2.0)])
def test_equals_scoring_every_pair(spark, monkeypatch, size, spread):
    monkeypatch.setattr(hard, "ROW_BYTES", 8 * size * 60)
    monkeypatch.setattr(hard, "ANCHOR_BYTES", 8 * size * 9)
    monkeypatch.setattr(hard, "STEP_ROWS", 25)
    rows = clustered(size, 300, size, spread)
    assert mined(spark, rows) == expected(rows) != []


def test_ties_copies_repeats_and_lengths(spark):
    rng = random.Random(3)
    rows = [(i, i % 3, i % 7 == 0, (rng.randint(-3, 3), rng.randint(-3, 3))) for i in range(120)]
    # copies of one vector, repeated rows, one id with two vectors, another length, a null vector of zeros
    rows += [(200 + i, i % 2, i % 50 == 0, (2, 1)) for i in range(150)] + rows[:20]
    rows += [(7, 1, True, (3, 3)), (500, 0, True, (1, 2, 3)), (501, 0, False, (1, 2, 2)), (502, 1, False, (1, 1, 1)), (503, 0, True, (0, 0))]
    assert mined(spark, rows) == expected(rows)
    assert mined(spark, rows, positives=2, negatives=3, low=50, high=100) == expected(rows, 2, 3, 50, 100)


def test_empty_and_alone(spark):
    schema = "vec_id long, label long, anchor boolean, vector array<long>"
    assert hard.mine(spark.createDataFrame([], schema)).count() == 0
    assert mined(spark, [(100, 1, True, (5, 5))]) == []
    assert mined(spark, [(100, 1, True, (5, 5)), (1, 2, False, (4, 4))]) == []


def test_intervals_hold_the_product_and_exclude_rows():
    rng = np.random.default_rng(5)
    for size in (5, 64, 300):
        rows = np.floor(rng.normal(size=(400, size)) * 50)
        anchors = np.floor(np.vstack([rng.normal(size=(30, size)) * 50, rows[:5] + rng.normal(size=(5, size)), np.zeros((1, size))]))
        bits, alignment, rest, length = hard.coded(rows)
        low, high = hard.Planes(anchors).intervals(slice(None), bits, alignment, rest, length)
        products = anchors @ rows.T
        assert (low <= products).all() and (products <= high).all()
        # wide as they are, they tell a row's own copy from most others
        assert (high[30:35] < products[30:35, :5].max(1, keepdims=True)).mean() > (0.25 if size > 5 else 0.1)


def test_scores_of_large_components():
    anchor = np.array([2**40, -(2**33), 5])
    rows = np.array([[2**20, 2**18, 7], [-(2**21), 3, 2**30]])
    exact = [sum(int(x) * int(y) for x, y in zip(anchor, row)) for row in rows]
    assert hard.Scores(rows)(anchor, np.arange(2)).tolist() == exact
    with pytest.raises(OverflowError):
        hard.Scores(rows * 2**10)(anchor, np.arange(2))


def test_rows_that_take_no_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1, "x"), (1, [1.0, 0.4], 1, "x"), (2, [0.5, 0.3], 2, "x"), (7, [0.4, 0.1], 0, "x"),
        (3, None, 1, "x"), (4, [1.0, nan], 1, "x"), (5, [inf, 1.0], 2, "x"), (6, [None, 1.0], 2, "x"),
        (8, [1.0, 0.5], None, "x"), (None, [1.0, 0.5], 1, "x"), (9, [], 1, "x"), (10, [1.0, 1.0, 1.0], 1, "x"),
        (2, [0.5, 0.3], 2, "x"),
    ]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, anchor string").write.parquet(str(tmp_path / "embeddings.parquet"))
    # 0 and 7 move on to the next label: 0 has label 2, 7 has label 1
    found = hard.op13_hard_negatives(spark, str(tmp_path)).collect()
    whole = {key: tuple(math.floor(256 * np.float32(x)) for x in v) for key, v, *_ in rows if key in (0, 1, 2, 7)}
    want = expected([(0, 2, True, whole[0]), (1, 1, False, whole[1]), (2, 2, False, whole[2]), (7, 1, False, whole[7])])
    assert sorted(tuple(row) for row in found) == want != []

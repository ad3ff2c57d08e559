import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyscore.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def brute(rows, k=5, every=50):
    vectors = {}
    for vec_id, v, *_ in rows:
        if vec_id is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        vectors[vec_id] = np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)
    out = []
    for i, q in vectors.items():
        if i % every == 0:
            scores = sorted((-int(q @ v), j) for j, v in vectors.items() if j != i and len(v) == len(q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, **more):
    df = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, **more)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dims,values", [(3, 3), (8, 50), (1, 2)])
def test_same_as_brute_force_with_many_ties(spark, monkeypatch, dims, values):
    rng = random.Random(dims)
    monkeypatch.setattr(topk, "CELL_ROWS", 100)
    monkeypatch.setattr(topk, "CELL_QUERIES", 4)
    rows = [(i, [rng.randrange(-values, values) / 64 for _ in range(dims)], None, "x") for i in range(600)]
    assert found(spark, rows) == brute(rows)


def test_one_vector_in_a_third_of_rows(spark):
    rng = random.Random(5)
    same = [0.5, -0.25, 0.125, 1.0]
    rows = [(i, same if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(4)], 1, None) for i in range(1000)]
    assert found(spark, rows) == brute(rows)


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0], 1, "a"),
        (50, None, 1, "a"),
        (100, [1.0, None], 1, "a"),
        (150, [float("nan"), 1.0], 1, "a"),
        (200, [float("inf"), 1.0], 1, "a"),
        (None, [1.0, 1.0], 1, "a"),
        (250, [], 1, "a"),
        (300, [0.0, 0.0], 1, "a"),
        (350, [1.0, 2.0, 3.0], 1, "a"),
        (7, [-1.0, 0.5], 1, "a"),
        (-50, [0.25, 0.5], 1, "a"),
    ]
    assert found(spark, rows) == brute(rows)
    # repeated rows count once
    assert found(spark, rows * 2) == brute(rows)


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1, "")]) == []
    assert found(spark, [(1, [1.0], 1, ""), (2, [1.0], 1, "")]) == []


def test_search_stops_before_the_end_of_its_lists():
    rng = np.random.default_rng(1)
    x = rng.integers(-100, 100, (4096, 4))
    x[7] = 1000
    looks = []
    add = topk.Best.add

    class Counted(topk.Best):
        def add(self, *args):
            looks.append(1)
            add(self, *args)

    original, topk.Best = topk.Best, Counted
    try:
        best = topk.threshold_search(x, np.arange(4096), np.array([[1, 1, 1, 1]]), np.array([topk.NONE]), 1)
    finally:
        topk.Best = original
    assert best.id.tolist() == [7] and len(looks) == 1


def test_wide_components():
    x = np.array([[1 << 30, 3], [1 << 30, 4], [-5, 1]])
    best = topk.threshold_search(x, np.arange(3), np.array([[1 << 31, 1]]), np.array([topk.NONE]), 3)
    assert best.id.tolist() == [1, 0, 2] and best.score.tolist() == [(1 << 61) + 4, (1 << 61) + 3, -5 * (1 << 31) + 1]
    with pytest.raises(ArithmeticError):
        topk.products_as(np.array([[1 << 40]]), np.array([[1 << 40]]))

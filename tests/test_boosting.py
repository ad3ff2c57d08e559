import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from keyscore.operators import boosting
from keyscore.operators.boosting import BoostedTrees, bin_starts, fit_boosted_trees
from keyscore.operators.epochs import ScoreLog, fit_softmax_epochs
from keyscore.operators.evaluation import accuracy, flat_trees, forest_votes, loss_history, margins_by_round
from keyscore.operators.training import fit_boosted_forest, fit_gbt, fit_random_forest


def table(spark, rows):
    df = spark.createDataFrame(rows, "id int, label int, x array<double>").coalesce(2)
    return df.withColumn("features", array_to_vector("x")).cache()


@pytest.fixture(scope="module")
def squares(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1200):
        x = [rng.uniform(-1, 1), rng.uniform(-1, 1), float(rng.randrange(3)), 7.0]
        rows.append((i, int((x[0] > 0) != (x[1] > 0.2)), x))
    return table(spark, rows)


def sums(node, rows, margins, trees, tree):
    """Gradient and hessian sums of the rows that reach a node."""
    g = h = 0.0
    for (label, x), m in zip(rows, margins):
        at = 1
        while at != node and trees[tree].get(at) is not None and trees[tree][at].slot >= 0:
            n = trees[tree][at]
            at = 2 * at + (0 if x[n.slot] < n.threshold else 1)
            if at > node:
                break
        if at == node:
            p = 1 / (1 + math.exp(-m))
            g, h = g + p - label, h + p * (1 - p)
    return g, h


def test_gain_and_cover_are_sums_over_the_rows_of_a_node(squares):
    model = fit_boosted_trees(squares, rounds=3, depth=3, bins=64)
    rows = [(r.label, r.x) for r in squares.collect()]
    margins = [0.0] * len(rows)
    part = lambda g, h: g * g / (h + 1)
    for t, tree in enumerate(model.trees):
        for i, node in tree.items():
            g, h = sums(i, rows, margins, model.trees, t)
            assert node.cover == pytest.approx(h) and node.weight == pytest.approx(-0.3 * g / (h + 1))
            if node.slot >= 0:
                low, high = (sums(c, rows, margins, model.trees, t) for c in (2 * i, 2 * i + 1))
                assert node.gain == pytest.approx(part(*low) + part(*high) - part(g, h)) and node.gain > 0
        for k, (_, x) in enumerate(rows):
            at = 1
            while tree[at].slot >= 0:
                at = 2 * at + (0 if x[tree[at].slot] < tree[at].threshold else 1)
            margins[k] += tree[at].weight
    scored = {r.id: r.margins for r in model.transform(squares).collect()}
    ids = [r.id for r in squares.collect()]
    assert [scored[i][-1] for i in ids] == pytest.approx(margins)
    assert 3 not in {n.slot for n in model.nodes}  # a constant slot cannot split


def test_margins_written_in_between_change_nothing(spark, squares, monkeypatch):
    whole = fit_boosted_trees(squares, rounds=4, depth=2)
    monkeypatch.setattr(boosting, "WRITTEN", 1)
    parts = fit_boosted_trees(squares.repartition(5), rounds=4, depth=2)
    pick = lambda m: [(n.tree, n.node, n.slot, n.threshold) for n in m.nodes]
    assert repr(pick(whole)) == repr(pick(parts))
    assert accuracy(fit_boosted_trees(squares, rounds=8, depth=3).transform(squares)).first().accuracy > 0.9


def test_saved_trees_score_the_same(spark, squares, tmp_path):
    model = fit_boosted_trees(squares, rounds=2)
    again = BoostedTrees.load(spark, model.save(spark, str(tmp_path / "trees")))
    pairs = [sorted((r.id, tuple(r.margins), r.prediction) for r in m.transform(squares).collect()) for m in (model, again)]
    assert pairs[0] == pairs[1]
    assert {r.slot for r in model.importances(spark).collect()} == {n.slot for n in model.nodes if n.slot >= 0}


def test_bins_and_odd_values(spark):
    rows = [(i, i % 2, [float(i // 250), math.nan if i % 5 == 0 else float(i)]) for i in range(1000)]
    df = table(spark, rows)
    starts = bin_starts(df, "x", bins=8)
    assert starts[0].tolist() == [1.0, 2.0, 3.0] and len(starts[1]) <= 8
    model = fit_boosted_trees(df, rounds=1)
    assert len(model.transform(df).collect()) == 1000
    with pytest.raises(ValueError):
        fit_boosted_trees(df.limit(0))


def test_flat_trees_are_the_models(spark, squares):
    gbt, forest, chain = fit_gbt(squares, iters=6), fit_random_forest(squares, trees=9), fit_boosted_forest(squares, rounds=3, trees=4)
    rows = margins_by_round(gbt.transform(squares), gbt).collect()
    assert all(r.rawPrediction[1] == pytest.approx(r.margins[-1]) and len(r.margins) == 6 for r in rows)
    rows = forest_votes(forest.transform(squares), forest).collect()
    assert all(r.probability[1] == pytest.approx(r.vote) for r in rows)
    rows = margins_by_round(chain.transform(squares), chain).collect()
    assert all(r.margin == pytest.approx(r.margins[-1]) and len(r.margins) == 3 for r in rows)
    one = fit_gbt(squares, iters=1)
    size = lambda m: margins_by_round(squares, m)._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(one) == size(gbt)
    assert flat_trees(one).depth <= 5


def test_softmax_epochs_hear_their_losses(spark, squares):
    log = ScoreLog(every=2)
    batch = F.pmod(F.col("id"), F.lit(3))
    layer = fit_softmax_epochs(squares, batch, 3, epochs=3, rate=0.2, listener=log)
    assert [s for s, _ in log.rows] == [0, 2, 4, 6, 8] and log.rows[0][1] == pytest.approx(math.log(2))
    assert log.table(spark).count() == 5
    data = squares.collect()
    for step, loss in log.rows:
        w = log.layers[step]
        part = [(r.label, np.dot(w.weights, r.x) * 2 + 2 * w.intercept) for r in data if r.id % 3 == step % 3]
        assert loss == pytest.approx(np.mean([math.log1p(math.exp(-abs(m))) + max(m, 0) - y * m for y, m in part]))
    assert layer.transform(squares).filter("prediction IN (0, 1) AND p1 BETWEEN 0 AND 1").count() == 1200
    with pytest.raises(ValueError):
        fit_softmax_epochs(squares.limit(0), batch, 3)
    assert loss_history(fit_gbt(squares, iters=2), squares).count() == 2


def test_bins_are_counted_without_a_row_for_each_value(spark, monkeypatch):
    rng = random.Random(12)
    odd = [math.nan, -math.inf, math.inf, -0.0, 1e308]
    rows = [(i, 0, [rng.gauss(0, 1), float(rng.randrange(3)), 7.0, rng.choice((*odd[:1], rng.random())), rng.choice((*odd, rng.random())), math.nan]) for i in range(500)]
    bins, steps = 16, 64
    want = []
    for slot in range(6):
        values = [x[slot] for _, _, x in rows]
        real = [v for v in values if not math.isnan(v)]
        low, high = min(real, default=math.nan), max(real, default=math.nan)
        cells = {}
        for v in values:
            with np.errstate(all="ignore"):
                share = (np.float64(v) - low) / (np.float64(high) - low) * steps
            step = steps if math.isnan(v) else 0 if not high > low else 0 if math.isnan(share) else min(math.floor(share), steps - 1)
            cells.setdefault(step, []).append(v)
        before, starts = 0, {}
        for step in sorted(cells):
            starts.setdefault(before * bins // len(values), min(cells[step]))
            before += len(cells[step])
        want.append(list(starts.values())[1:])
    df = spark.createDataFrame([(x,) for _, _, x in rows] + [(None,)], "x array<double>").repartition(3)
    monkeypatch.setattr(boosting.F, "posexplode", None)
    got = bin_starts(df, "x", bins, steps)
    assert [len(g) for g in got] == [len(w) for w in want]
    for g, w in zip(got, want):
        assert np.array_equal(g, w, equal_nan=True)

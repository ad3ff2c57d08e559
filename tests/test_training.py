import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from keyscore.operators import training
from keyscore.operators.evaluation import (
    accuracy,
    auc_by_round,
    auc_hard,
    auc_score,
    centers,
    confusion,
    importances,
    loss_history,
    prf,
    silhouette,
)
from keyscore.operators.training import (
    fit_boosted_forest,
    fit_gbt,
    fit_kmeans,
    fit_linear_svc,
    fit_logreg,
    fit_per_stream,
    fit_random_forest,
    fit_rbf_svm,
    fit_softmax_lr,
    reload_parity,
)
from keyscore.sources.registry import load_model, load_models, load_registry, save_model
from tests.fixtures import STREAMS


def table(spark, rows):
    df = spark.createDataFrame(rows, "uuid string, label int, x array<double>")
    return df.coalesce(2).select("uuid", "label", array_to_vector("x").alias("features")).cache()


@pytest.fixture(scope="module")
def linear(spark):
    """P(label = 1) = logistic(2a - 3b + 0.5)."""
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        p = 1 / (1 + math.exp(-(2 * a - 3 * b + 0.5)))
        rows.append((f"u{i}", int(rng.random() < p), [a, b]))
    return table(spark, rows)


@pytest.fixture(scope="module")
def ring(spark):
    """A disc inside a ring: no line separates them."""
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        label = i % 2
        radius, angle = (rng.uniform(0, 0.8) if label else rng.uniform(1.2, 2.0)), rng.uniform(0, 2 * math.pi)
        rows.append((f"u{i}", label, [radius * math.cos(angle), radius * math.sin(angle)]))
    return table(spark, rows)


def test_weights_of_a_known_model(linear):
    model = fit_logreg(linear, reg=0.0, elastic=0.0)
    assert list(model.coefficients) == pytest.approx([2.0, -3.0], abs=0.3)
    assert model.intercept == pytest.approx(0.5, abs=0.2)
    soft = fit_softmax_lr(linear)
    weights = soft.coefficientMatrix.toArray()
    assert list(weights[1] - weights[0]) == pytest.approx(list(model.coefficients), abs=1e-2)
    history = [r.loss for r in loss_history(model, linear).orderBy("iteration").collect()]
    assert history[-1] < history[0]


def test_linear_models_beat_a_floor(linear):
    for fit in (fit_logreg, fit_linear_svc):
        assert accuracy(fit(linear).transform(linear)).first().accuracy > 0.8


def test_rbf_svm_separates_a_ring_and_reloads(spark, ring, tmp_path):
    flat = accuracy(fit_linear_svc(ring).transform(ring)).first().accuracy
    model = fit_rbf_svm(ring, size=2)
    assert accuracy(model.transform(ring)).first().accuracy > 0.97 > flat + 0.2
    again = load_model("rbf", save_model(model, str(tmp_path / "rbf")))
    assert again.params == model.params and again.sv_df.count() == model.params.total_sv
    first, second = (
        {r.uuid: r.prediction for r in m.transform(ring).select("uuid", "prediction").collect()} for m in (model, again)
    )
    assert first == second


def test_rbf_svm_keeps_no_kernel_values(spark, ring, monkeypatch):
    """Every pass starts from the rows as they are, and the fit is no worse than Spark's on the kernel values themselves."""
    kept, sums = lambda: spark.sparkContext._jsc.getPersistentRDDs().size(), training.kernel_sums
    before, widths = kept(), []

    def seen(rows, marks, gamma, *points):
        widths.append((kept() - before, rows.selectExpr("max(size(x))").first()[0]))
        return sums(rows, marks, gamma, *points)

    monkeypatch.setattr(training, "kernel_sums", seen)
    model = fit_rbf_svm(ring, size=2, n_components=20)
    assert len(widths) > 3 and set(widths) == {(0, 2)}
    marks = training.landmarks(ring, 20)
    x = np.array([r[0].toArray() for r in ring.select("features").collect()])
    near = lambda a: np.exp(-0.5 * ((a[:, None, :] - marks[None]) ** 2).sum(2))
    values, vectors = np.linalg.eigh(near(marks))
    whiten = vectors[:, values > values.max() * 1e-10] / np.sqrt(values[values > values.max() * 1e-10])
    labels = [r.label for r in ring.select("label").collect()]
    lifted = spark.createDataFrame([(v.tolist(), y) for v, y in zip(near(x) @ whiten, labels)], "v array<double>, label int")
    penalty = 1 / (2.0 * len(labels))
    spark_fit = LinearSVC(maxIter=100, tol=1e-4, regParam=penalty, standardization=False).fit(lifted.select(array_to_vector("v").alias("features"), "label"))
    sign = 2 * np.array(labels) - 1

    def objective(w, margins):
        return np.maximum(1 - sign * margins, 0).mean() + penalty / 2 * (w**2).sum()

    by_mark = {tuple(r.vector): r.coef for r in model.sv_df.collect()}
    coefs = np.array([by_mark.get(tuple(m), 0.0) for m in marks.tolist()])
    ours = np.linalg.lstsq(whiten, coefs, rcond=None)[0]
    theirs = spark_fit.coefficients.toArray()
    assert objective(ours, near(x) @ coefs - model.params.rho) <= objective(theirs, near(x) @ whiten @ theirs + spark_fit.intercept) * 1.01 + 1e-3


def test_rbf_svm_refuses_what_it_cannot_fit(spark, ring):
    for label, x in ((2, [0.0, 1.0]), (1, [float("nan"), 1.0]), (None, [0.0, 1.0])):
        odd = spark.createDataFrame([("o", label, x)], "uuid string, label int, x array<double>").select("uuid", "label", array_to_vector("x").alias("features"))
        with pytest.raises(Exception, match="must be"):
            fit_rbf_svm(ring.unionByName(odd), size=2, n_components=10)


def test_boosted_forest(ring, tmp_path):
    model = fit_boosted_forest(ring, rounds=3, trees=10)
    scored = model.transform(ring)
    assert accuracy(scored).first().accuracy > 0.97
    assert auc_score(scored, "margin").first().auc > 0.99
    again = PipelineModel.load(save_model(model, str(tmp_path / "forest")))
    pairs = scored.select("uuid", "margin").collect(), again.transform(ring).select("uuid", "margin").collect()
    assert sorted(map(tuple, pairs[0])) == sorted(map(tuple, pairs[1]))
    rounds = auc_by_round(ring, model).orderBy("round").collect()
    assert len(rounds) == 3 and rounds[2].auc == pytest.approx(auc_score(scored, "margin").first().auc)
    table = importances(ring.sparkSession, str(tmp_path / "forest" / "stages" / "*Forest*"))
    text = "".join(s.toDebugString for s in model.stages if hasattr(s, "trees"))
    assert {r.slot: r.splits for r in table.collect()} == {s: text.count(f"If (feature {s} ") for s in (0, 1)}


def test_boosted_rounds(ring):
    model = fit_gbt(ring, iters=4, step=0.3, depth=3)
    rows = auc_by_round(ring, model).orderBy("round").collect()
    last = accuracy(model.transform(ring)).first().accuracy
    assert len(rows) == 4 and rows[-1].auc >= rows[0].auc and rows[-1].auc > 0.99 and last > 0.97
    losses = [r.loss for r in loss_history(model, ring).orderBy("iteration").collect()]
    assert losses == sorted(losses, reverse=True)


def test_reload_parity(ring, tmp_path):
    for kind, model in (("rf", fit_random_forest(ring, trees=5)), ("kmeans", fit_kmeans(ring))):
        rows = reload_parity(model, kind, str(tmp_path / kind), ring)
        assert rows.count() == 1500 and rows.filter(~F.col("same")).count() == 0


def test_importances_count_the_splits_of_the_trees(spark, ring, tmp_path):
    model = fit_random_forest(ring, trees=6, depth=3)
    path = save_model(model, str(tmp_path / "rf"))
    got = {r.slot: r for r in importances(spark, path).collect()}
    text = model.toDebugString
    for slot in (0, 1):
        assert got[slot].splits == text.count(f"If (feature {slot} ")
        assert got[slot].gain > 0 and 0 < got[slot].cover <= 1500


def test_kmeans_centers_are_means(spark):
    rng = random.Random(9)
    rows = [(f"u{i}", i % 2, [10.0 * (i % 2) + rng.gauss(0, 0.1), rng.gauss(0, 0.1)]) for i in range(400)]
    df = table(spark, rows)
    model = fit_kmeans(df)
    got = {(r.cluster, r.slot): r.value for r in centers(spark, model).collect()}
    clusters = {r.uuid: r.prediction for r in model.transform(df).collect()}
    for cluster in (0, 1):
        members = [x for u, _, x in rows if clusters[u] == cluster]
        assert len(members) == 200
        for slot in (0, 1):
            assert got[cluster, slot] == pytest.approx(sum(m[slot] for m in members) / 200)
    assert silhouette(model.transform(df)).first().silhouette > 0.99


def test_metrics_by_hand(spark):
    rows = [(1, 1)] * 5 + [(1, 0)] * 3 + [(0, 1)] * 2 + [(0, 0)] * 10
    df = spark.createDataFrame(rows, "label int, prediction int")
    assert {(r.label, r.prediction): r["count"] for r in confusion(df).collect()} == {
        (1, 1): 5, (1, 0): 3, (0, 1): 2, (0, 0): 10,
    }
    got = prf(df).first()
    assert (got.precision, got.recall) == (5 / 7, 5 / 8)
    assert got.f1 == pytest.approx(2 * 5 / 7 * 5 / 8 / (5 / 7 + 5 / 8))
    assert auc_hard(df).first().auc == pytest.approx((5 / 8 + 10 / 12) / 2)
    assert accuracy(df).first().accuracy == 0.75
    none = prf(df.withColumn("prediction", F.lit(0))).first()
    assert none.precision is None and none.recall == 0.0


def test_auc_with_ties_brute_force(spark):
    rng = random.Random(10)
    rows = [(rng.randint(0, 1), float(rng.choice([0, 0, 0, 1, 2, 3]))) for _ in range(300)]
    pos, neg = ([s for y, s in rows if y == v] for v in (1, 0))
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    df = spark.createDataFrame(rows, "label int, score double")
    assert auc_score(df).first().auc == pytest.approx(wins / (len(pos) * len(neg)))


def test_fit_per_stream(spark, tmp_path):
    rng = random.Random(11)
    press, wash = [], []
    for i in range(200):
        hot = i % 2
        press.append((f"h{i}", "t", hot, i % 3, i // 2 % 2, hot * 10 + rng.random(), rng.random()))
        wash.append((f"c{i}", "t", hot, i // 2 % 2, -hot * 5 + rng.random()))
    head = "uuid string, currentTime string, result int"
    frames = {
        "press": spark.createDataFrame(press, f"{head}, mode int, lid int, heat double, flow double").coalesce(1),
        "wash": spark.createDataFrame(wash, f"{head}, grade int, weight double").coalesce(1),
    }
    fit_per_stream(frames, STREAMS, str(tmp_path), kinds=("svc", "lr"))
    registry = load_registry(STREAMS, str(tmp_path))
    assert (tmp_path / "svc-spark-pressing").exists() and set(registry) == {"press", "wash"}
    for key, entry in registry.items():
        scored = entry.model.transform(entry.features.transform(frames[key].withColumnRenamed("result", "label")))
        assert accuracy(scored).first().accuracy == 1.0
    assert set(load_models({"LR": "lr", "SVC": "svc"}, str(tmp_path), "wash")) == {"LR", "SVC"}


def test_parity_fits_run_beside_each_other(spark, sf_dir, monkeypatch):
    """Four kinds wait for one another, so fits in turn would not end; each kind is still fitted once and compared whole."""
    from threading import Barrier

    from keyscore.plans import fits

    together, fitted = Barrier(4, timeout=60), []

    def fit(kind):
        def run(rows, *_):
            together.wait()
            fitted.append(kind)
            return kind

        return run

    monkeypatch.setattr(fits, "FITS", {kind: fit(kind) for kind in fits._kinds if kind != "rbf"})
    monkeypatch.setattr(fits, "fit_rbf_svm", fit("rbf"))
    monkeypatch.setattr(fits, "reload_parity", lambda model, kind, path, df: df.selectExpr(f"'{model}' = '{kind}' AS same"))
    rows = fits.reload_parity_query(spark, sf_dir).collect()
    assert sorted(fitted) == sorted(r.model for r in rows) == sorted(fits._kinds)
    assert all(r.rows == 1000 and r.differ == 0 for r in rows)

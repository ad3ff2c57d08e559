import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keyscore.functions.scalar import argmax2, fmt, round_label
from keyscore.operators.scoring import SvmTextModel, nearest_center, score_linear, score_rbf_svm, score_softmax, score_svm_model
from keyscore.operators.training import fit_rbf_svm, landmarks
from keyscore.operators.userfn import filter_records, map_records
from keyscore.sources.documents import read_svm_model, read_svmlight
from keyscore.sources.sinks import REPORT_SCHEMA, write_report
from keyscore.storage import forget, materialize


@pytest.fixture(scope="module")
def kernel(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    vectors = [(rng.choice([-2.0, 0.7, 2.0]), [rng.gauss(0, 1) for _ in range(4)]) for _ in range(2500)]
    return (
        spark.createDataFrame(rows, "id int, features array<double>"),
        spark.createDataFrame(vectors, "coef double, vector array<double>"),
        dict(rows),
        vectors,
    )


def brute_force(x, vectors, gamma, rho):
    total = 0.0
    for coef, v in vectors:
        total += coef * math.exp(-gamma * sum((a - b) ** 2 for a, b in zip(x, v)))
    return total - rho


@pytest.mark.parametrize("limit", [64 << 20, 40_000, 0], ids=["all held", "some held", "none held"])
def test_rbf_margin(kernel, limit):
    df, sv, rows, vectors = kernel
    scored = score_rbf_svm(df, sv, 0.25, 1.5, labels=(0, 1), held_bytes=limit).collect()
    assert len(scored) == len(rows)
    for r in scored:
        margin = brute_force(rows[r.id], vectors, 0.25, 1.5)
        assert r.margin == pytest.approx(margin, abs=1e-8)
        assert r.prediction == (0 if margin > 0 else 1)


def test_rbf_takes_vectors_and_refuses_wrong_lengths(spark, kernel):
    _, sv, _, vectors = kernel
    df = spark.createDataFrame([(Vectors.dense([0.1, 0.2, 0.3, 0.4]),)], ["features"])
    assert score_rbf_svm(df, sv, 0.25, 0.0).first().margin == pytest.approx(
        brute_force([0.1, 0.2, 0.3, 0.4], vectors, 0.25, 0.0), abs=1e-8
    )
    with pytest.raises(Exception):
        score_rbf_svm(spark.createDataFrame([([1.0],)], "features array<double>"), sv, 0.25, 0.0).collect()


MODEL = """svm_type c_svc
kernel_type rbf
gamma 0.5
nr_class 2
total_sv 3
rho -0.25
label 0 1
nr_sv 1 2
SV
2.0 0:0.0 1:0.0 
-1.5 0:1.0 1:0.5 
-0.5 0:2.5e-1 1:-1.0 
"""


def test_svm_model_file(spark, tmp_path):
    (tmp_path / "model.txt").write_text(MODEL)
    params, sv = read_svm_model(spark, str(tmp_path / "model.txt"))
    assert (params.gamma, params.rho, params.labels, params.nr_sv, params.total_sv) == (0.5, -0.25, (0, 1), (1, 2), 3)
    vectors = sorted((r.coef, r.vector) for r in sv.collect())
    assert vectors == [(-1.5, [1.0, 0.5]), (-0.5, [0.25, -1.0]), (2.0, [0.0, 0.0])]
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0, 0.5],)], "features array<double>")
    for r in score_svm_model(df, params, sv).collect():
        margin = brute_force(r.features, vectors, 0.5, -0.25)
        assert r.margin == pytest.approx(margin) and r.prediction == (0 if margin > 0 else 1)


def test_svm_model_with_gaps(spark, tmp_path):
    """Slots that a line leaves out are 0, also all of them; the numbers must agree with the header."""
    text = MODEL.replace("2.0 0:0.0 1:0.0 ", "2.0 ").replace("-1.5 0:1.0 1:0.5 ", "-1.5 2:0.5")
    (tmp_path / "model.txt").write_text(text)
    _, sv = read_svm_model(spark, str(tmp_path / "model.txt"))
    assert sorted((r.coef, r.vector) for r in sv.collect()) == [(-1.5, [0.0, 0.0, 0.5]), (-0.5, [0.25, -1.0, 0.0]), (2.0, [0.0] * 3)]
    for wrong in (text.replace("-0.5 0:2.5e-1 1:-1.0 \n", ""), text.replace("-0.5 0:", "x 0:"), text.replace("gamma 0.5", "gamma 0.5\ngamma 0.7")):
        (tmp_path / "wrong.txt").write_text(wrong)
        with pytest.raises(ValueError):
            read_svm_model(spark, str(tmp_path / "wrong.txt"))


def test_svmlight_entries_out_of_range(spark, tmp_path):
    (tmp_path / "rows.txt").write_text("1 0:0.5 1:0.1\n0 2:3\n1\n")
    rows = [(r.label, r.features) for r in read_svmlight(spark, str(tmp_path / "rows.txt"), 3, vector=False).collect()]
    assert rows == [(1, [0.5, 0.1, 0.0]), (0, [0.0, 0.0, 3.0]), (1, [0.0] * 3)]
    for wrong in ("1 0:0.5 1:0.1 5:9.0", "1 -1:2", "1 0:x", "1 7"):
        (tmp_path / "wrong.txt").write_text(wrong + "\n")
        with pytest.raises(Exception, match="not an entry"):
            read_svmlight(spark, str(tmp_path / "wrong.txt"), 3, vector=False).collect()


def test_svm_model_of_another_kernel(spark, tmp_path):
    (tmp_path / "model.txt").write_text(MODEL.replace("rbf", "linear"))
    with pytest.raises(ValueError):
        read_svm_model(spark, str(tmp_path / "model.txt"))


def test_nearest_center(spark):
    rng = np.random.RandomState(2)
    points, centers = rng.normal(size=(500, 3)), rng.normal(size=(4, 3))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, features array<double>")
    got = {r.id: r.prediction for r in nearest_center(df, centers).collect()}
    assert got == {i: int(((centers - p) ** 2).sum(1).argmin()) for i, p in enumerate(points)}


def test_nearest_center_tie_takes_the_first(spark):
    df = spark.createDataFrame([([0.0],)], "features array<double>")
    assert nearest_center(df, [[1.0], [-1.0]]).first().prediction == 0


def test_linear_and_softmax(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 0.0), (500.0, 1000.0)], "a double, b double")
    for r in score_linear(df, ["a", "b"], [1.0, -1.0], 0.0).collect():
        assert r.margin == r.a - r.b and r.prediction == 0
    assert [r.prediction for r in score_linear(df, ["a"], [1.0], 0.0, "margin").collect()] == [1, 0, 1]
    rows = score_softmax(df, ["a", "b"], [[1.0, 0.0], [0.0, 1.0]], [0.0, 0.0]).collect()
    assert [r.prediction for r in rows] == [1, 0, 1]  # equal probabilities give 0
    assert rows[0].p1 == pytest.approx(1 / (1 + math.exp(-1.0))) and rows[2].p1 == 1.0
    assert all(r.p0 + r.p1 == pytest.approx(1.0) for r in rows)


def test_rounding(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (0.51,)], "p double")
    row = df.select(round_label(F.col("p")).alias("l"), argmax2(1 - F.col("p"), F.col("p")).alias("m"), fmt(F.col("p")).alias("t"))
    assert [tuple(r) for r in row.collect()] == [(1, 0, "0.500"), (0, 0, "0.490"), (1, 1, "0.510")]


def test_record_functions(spark):
    def double(batches):
        for b in batches:
            yield b.assign(id=b["id"] * 2)

    df = filter_records(spark.range(10), F.col("id") < 3)
    assert sorted(r.id for r in map_records(df, double, "id long").collect()) == [0, 2, 4]


def test_a_fitted_machine_is_its_text(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, int(x * x + y * y < 1), [x, y]) for i, (x, y) in enumerate((rng.uniform(-2, 2), rng.choice([0.0, rng.uniform(-2, 2)])) for _ in range(600))]
    df = spark.createDataFrame(rows, "id int, label int, x array<double>").select("id", "label", array_to_vector("x").alias("features"))
    model = fit_rbf_svm(df, size=2, n_components=60)
    again = SvmTextModel.load(model.save(str(tmp_path / "svm.txt")))
    assert again.params == model.params and model.params.total_sv <= 60
    pairs = [{r.id: r.margin for r in m.transform(df).collect()} for m in (model, again)]
    assert pairs[0] == pairs[1]
    assert model.transform(df).filter("prediction = label").count() > 570
    # the coefficients of the first label come first, as the header's counts say
    assert [r.coef > 0 for r in again.sv_df.orderBy(F.desc("coef")).collect()] == [True] * model.params.nr_sv[0] + [False] * model.params.nr_sv[1]
    # the same landmarks however the rows are partitioned
    assert landmarks(df.repartition(7), 60).tolist() == landmarks(df, 60).tolist()


def test_rows_without_features_are_passed_over(spark, kernel):
    df, vectors, rows, _ = kernel
    half = df.withColumn("features", F.when(F.col("id") % 2 == 0, F.col("features")))
    some = {r.id: r.margin for r in score_rbf_svm(half, vectors, 0.3, 0.1).collect()}
    every = {r.id: r.margin for r in score_rbf_svm(df, vectors, 0.3, 0.1).collect()}
    assert all(some[i] is None if i % 2 else some[i] == pytest.approx(every[i]) for i in rows)


def test_a_report_that_is_written_again_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = lambda stream, value: spark.createDataFrame([(stream, "lr", "auc", value)], REPORT_SCHEMA)
    for stream, value in (("a", 0.1), ("b", 0.2), ("a", 0.3)):
        write_report(rows(stream, value), path)
    read = spark.read.schema(REPORT_SCHEMA).json(path)
    assert sorted((r.stream, r.value) for r in read.collect()) == [("a", 0.3), ("b", 0.2)]


def test_what_was_materialized_can_be_removed(spark):
    kept, gone = (materialize(spark.range(5), "test") for _ in range(2))
    forget(gone)
    forget(spark.range(3))
    assert kept.count() == 5
    with pytest.raises(Exception):
        gone.count()

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keyscore.operators.features import (
    assemble,
    build_pipeline,
    minmax,
    onehot,
    split_hash,
    split_nth,
    split_random,
)
from keyscore.operators.routing import branch, fanout, fanout_rows, rejects, score_multi_model, unmatched
from keyscore.operators.training import fit_linear_svc, fit_logreg
from keyscore.operators.features import feature_table
from keyscore.plans import endpoints
from keyscore.records import column_plan
from keyscore.sources import documents
from keyscore.sources.documents import read_feature_csv, read_svmlight
from keyscore.sources.sinks import write_feature_csv, write_svmlight
from tests.fixtures import RECORD_SCHEMA, SMALL, message, small_records

PLAN = column_plan(SMALL)


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(small_records(), RECORD_SCHEMA).coalesce(1).cache()


@pytest.fixture(scope="module")
def stages(records):
    return build_pipeline(PLAN).fit(records)


@pytest.fixture(scope="module")
def models(records, stages):
    table = feature_table(records, stages, PLAN).cache()
    return {"LR": fit_logreg(table), "SVC": fit_linear_svc(table)}


def test_drop_last_and_drop_first(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "c int")
    last = onehot(df, ["c"]).select("c", vector_to_array("cVec").alias("v"))
    first = onehot(df, ["c"], drop="first", sizes=[3]).select("c", F.col("cVec").alias("v"))
    assert {r.c: r.v for r in last.collect()} == {0: [1.0, 0.0], 1: [0.0, 1.0], 2: [0.0, 0.0]}
    assert {r.c: r.v for r in first.collect()} == {0: [0.0, 0.0], 1: [1.0, 0.0], 2: [0.0, 1.0]}


def test_constant_slot_and_values_outside_the_range(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    rows = minmax(assemble(df, ["a", "b"])).select(vector_to_array("features").alias("v")).collect()
    assert sorted(r.v for r in rows) == [[0.0, 0.5], [1.0, 0.5]]


def test_value_outside_the_fitted_range_is_not_clamped(spark, stages):
    row = spark.createDataFrame([("u", "t", 0, 1, 2, 1000.0, -1000.0)], RECORD_SCHEMA)
    values = stages.transform(row).select(vector_to_array("features").alias("v")).first().v
    assert values[-2] > 1 and values[-1] < 0


GOOD = message("good", [1, 2], [50.0, 60.0])
BAD = {
    "malformed": "not json",
    "null value": message("null", [1, None], [50.0, 60.0]),
    "unseen category": message("unseen", [1, 9], [50.0, 60.0]),
}


@pytest.mark.parametrize("reason", sorted(BAD))
def test_bad_record_fails_by_default(spark, stages, models, reason):
    df = spark.createDataFrame([("LR", GOOD), ("LR", BAD[reason])], "key string, value string")
    with pytest.raises(Exception):
        score_multi_model(df, stages, models, SMALL).collect()


def test_skip_and_side_output(spark, stages, models):
    rows = [("LR", GOOD), ("SVC", GOOD), ("NONE", GOOD), (None, GOOD)]
    rows += [(key, text) for key in ("LR", "NONE") for text in BAD.values()]
    df = spark.createDataFrame(rows, "key string, value string")
    scored = score_multi_model(df, stages, models, SMALL, on_invalid="skip")
    assert sorted(r.key for r in scored.collect()) == ["LR", "SVC"]
    assert {(r.key, r.reason) for r in rejects(df, SMALL, stages).collect()} == {
        (key, reason) for key in ("LR", "NONE") for reason in BAD
    }
    assert {r.key: r.n for r in unmatched(df, list(models)).collect()} == {"NONE": 4, None: 1}


def test_bad_record_of_an_unknown_key_does_no_harm(spark, stages, models):
    df = spark.createDataFrame([("LR", GOOD), ("NONE", BAD["malformed"])], "key string, value string")
    assert score_multi_model(df, stages, models, SMALL).count() == 1


def test_keep(spark, records):
    stages = build_pipeline(PLAN, on_invalid="keep").fit(records)
    row = spark.createDataFrame([("u", "t", 0, 1, 9, 1.0, 1.0)], RECORD_SCHEMA)
    assert stages.transform(row).select(vector_to_array("features").alias("v")).first().v[:5] == [0, 1, 0, 0, 0]


def test_scores_are_those_of_the_models(records, stages, models, spark):
    texts = [("LR" if i % 2 else "SVC", message(r[0], r[3:5], r[5:7], r[2])) for i, r in enumerate(small_records())]
    df = spark.createDataFrame(texts, "key string, value string")
    got = {r.uuid: (r.rawPrediction, r.prediction, r.label) for r in score_multi_model(df, stages, models, SMALL).collect()}
    table = feature_table(records, stages, PLAN)
    for parity, key in ((1, "LR"), (0, "SVC")):
        for r in models[key].transform(table).collect():
            if int(r.uuid[1:]) % 2 == parity:
                assert got[r.uuid] == (r.rawPrediction, r.prediction, r.label)
    assert len(got) == 200


def test_branches(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "key string, v int")
    big, isb = F.col("v") >= 2, F.col("key") == "b"
    assert {r.key: r.branch for r in branch(df, [("B", isb), ("BIG", big)]).collect()} == {"b": "B", "c": "BIG"}
    copies = {(r.branch, r.key) for r in fanout_rows(df, {"B": isb, "BIG": big}).collect()}
    apart = {(n, r.key) for n, d in fanout(df, {"B": isb, "BIG": big}).items() for r in d.collect()}
    assert copies == apart == {("B", "b"), ("BIG", "b"), ("BIG", "c")}


def test_feature_files_round_trip(spark, tmp_path):
    rows = [(1, [0.1234, -0.5, 1.0, 0.0, 1.0]), (0, [2.0, 0.0, 0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "label int, features array<double>")
    expected = sorted([(1, [0.123, -0.5, 1.0, 0.0, 1.0]), (0, [2.0, 0.0, 0.0, 1.0, 0.0])])
    for write, read in ((write_svmlight, read_svmlight), (write_feature_csv, read_feature_csv)):
        path = write(df, SMALL, str(tmp_path / write.__name__))
        assert sorted((r.label, r.features) for r in read(spark, path, 5, vector=False).collect()) == expected
    lines = [r.value for r in spark.read.text(str(tmp_path / "write_svmlight")).collect()]
    assert "1 0:0.123 1:-0.500 2:1 3:0 4:1 " in lines


def test_svmlight_sparse_line(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1 0:0.5 3:2\n\n0 1:1\n")
    rows = read_svmlight(spark, str(tmp_path / "x.txt"), 4, vector=False).collect()
    assert sorted(r.features for r in rows) == [[0.0, 1.0, 0.0, 0.0], [0.5, 0.0, 0.0, 2.0]]


def test_feature_text_is_that_of_the_format(spark, tmp_path):
    odd = [0.0, -0.0, float("nan"), float("inf"), 0.0005, -0.0004, 1.0005, 2.6745, 1e14, -1e300, None, 7.0]
    rows = [(0, [x, 1.5, 1.0, 0.0, 1.0]) for x in odd]
    path = write_svmlight(spark.createDataFrame(rows, "label int, features array<double>"), SMALL, str(tmp_path / "x"))
    text = spark.createDataFrame([(x,) for x in odd], "x double").select(F.format_string("0 0:%.3f 1:1.500 2:1 3:0 4:1 ", "x"))
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(r[0] for r in text.collect())


def test_whole_lines_are_cut_at_once(spark, tmp_path, monkeypatch):
    """A line with all slots in order never reaches the way that takes it pair by pair; others give the same as there."""
    pairs = spark.createDataFrame([(["0:1e3", "1:NaN", "2:-4"],), (["2:1", "0:5"],), (["00:1", "1:2", "2:3"],), ([],)], "p array<string>")
    slow = documents._dense_by_pair(F.col("p"), 3)
    assert pairs.where(~documents.dense(F.col("p"), 3).eqNullSafe(slow)).isEmpty()
    monkeypatch.setattr(documents, "_dense_by_pair", lambda p, width: F.raise_error(F.lit("by pair")).cast("array<double>"))
    whole = spark.createDataFrame([(["0:1e3", "1:2", "2:-4"],)], "p array<string>")
    assert whole.select(documents.dense(F.col("p"), 3)).first()[0] == [1000.0, 2.0, -4.0]


def test_a_packed_file_is_spread_over_the_cores(spark, tmp_path):
    spark.range(60_000).coalesce(1).write.parquet(str(tmp_path / "packed"))
    rows = endpoints.spread(spark.read.parquet(str(tmp_path / "packed")))
    assert rows.rdd.getNumPartitions() == 6 and rows.count() == rows.distinct().count() == 60_000
    assert endpoints.spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == 1


def test_no_task_gets_millions_of_rows(spark, monkeypatch):
    """Though there are as many parts as cores, a table of many rows is dealt out further."""
    monkeypatch.setattr(endpoints, "MOST_ROWS", 5_000)
    cores = spark.sparkContext.defaultParallelism
    rows = endpoints.spread(spark.range(0, 20_000 * cores, 1, cores))
    assert rows.rdd.getNumPartitions() == 4 * cores and rows.count() == rows.distinct().count() == 20_000 * cores


@pytest.mark.parametrize("n", [2, 5])
def test_split_nth_brute_force(spark, n):
    ids = list(range(5000))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(f"{i:05d}",) for i in ids], "id string").repartition(7)
    rows = sorted((r.id, r.k, r.is_test) for r in split_nth(df, ["id"], n).collect())
    assert rows == [(f"{i:05d}", i, i % n == 0) for i in range(5000)]


def test_split_nth_with_a_hot_value(spark):
    """A third of the rows share the order column: numbers are still 0..n-1, and the rows are spread."""
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    rows = split_nth(df, ["v"], 5).collect()
    assert sorted(r.k for r in rows) == list(range(9000))
    assert [r.v for r in sorted(rows, key=lambda r: r.k)] == sorted(r.v for r in rows)
    assert sum(r.is_test for r in rows) == 1800


def test_splits_are_partitions(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    for train, test in (split_hash(df, "id", 20), split_random(df)):
        a, b = ({r.id for r in part.collect()} for part in (train, test))
        assert len(a) + len(b) == 2000 and not a & b and 300 < len(b) < 500
    again = split_hash(df.repartition(13), "id", 20)[1]
    assert {r.id for r in again.collect()} == {r.id for r in split_hash(df, "id", 20)[1].collect()}

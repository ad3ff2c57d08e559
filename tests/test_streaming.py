import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyscore.functions.scalar import parse_json
from keyscore.operators.features import build_pipeline, feature_table, fit_stages
from keyscore.operators.routing import score_multi_model, score_multi_schema, score_or_reject, score_variant, stage_by_key, union_all
from keyscore.operators.training import fit_linear_svc, fit_logreg, fit_per_stream
from keyscore.records import MESSAGE_SCHEMA, column_plan
from keyscore.sources.documents import read_documents
from keyscore.sources.registry import load_registry
from keyscore.sources.streams import read_stream
from keyscore.streaming.jobs import (
    count_routing,
    idempotent_writer,
    ProgressLog,
    multi_model_results,
    run_for,
    multi_schema_results,
    write_idempotent,
    write_stream,
)
from keyscore.streaming.outputs import published_sink, read_published, read_rows, row_writer, write_published, write_rows
from tests.fixtures import RECORD_SCHEMA, SMALL, STREAMS, message, small_records

RESULT = "key string, uuid string, CurrentTime string, label int, prediction double"


@pytest.fixture(scope="module")
def job(spark):
    records = spark.createDataFrame(small_records(), RECORD_SCHEMA).coalesce(1)
    plan = column_plan(SMALL)
    stages = build_pipeline(plan).fit(records)
    rows = feature_table(records, stages, plan).cache()
    return stages, {"LR": fit_logreg(rows), "SVC": fit_linear_svc(rows)}


def put(spark, path, start, stop, files=2):
    keys = ("LR", "SVC", "NONE")
    rows = [(keys[i % 3], message(r[0], r[3:5], r[5:7], r[2])) for i, r in enumerate(small_records())][start:stop]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).repartition(files).write.mode("append").json(path)


def results(spark, out):
    rows = parse_json(spark.read.schema(MESSAGE_SCHEMA).parquet(out).select("key", "value"), RESULT).select("data.*")
    return sorted((r.key, r.uuid, r.label, r.prediction) for r in rows.collect())


def batch_results(spark, path, job):
    scored = score_multi_model(spark.read.schema(MESSAGE_SCHEMA).json(path), *job, SMALL)
    return sorted((r.key, r.uuid, r.label, r.prediction) for r in scored.collect())


def test_stream_equals_batch_over_a_restart(spark, tmp_path, job):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for start, stop in ((0, 90), (90, 200)):
        put(spark, source, start, stop)
        stream = multi_model_results(read_stream(spark, "json", {"path": source}, max_per_trigger=1), *job, SMALL)
        with ProgressLog(spark, str(tmp_path / "progress")) as log:
            run = write_stream(stream, "parquet", {"path": out}, checkpoint, available_now=True)
            run.awaitTermination()
            reports = log.of(run).collect()
        assert {p.sources for p in reports} == {1}
        # one read whatever the number of models; unknown keys may leave inside the scan
        assert 0 < sum(p.rows for p in reports) <= stop - start
    assert results(spark, out) == batch_results(spark, source, job)
    assert len(results(spark, out)) == sum(1 for i in range(200) if i % 3 != 2)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    out, write = str(tmp_path / "out"), idempotent_writer(str(tmp_path / "out"))
    for batch_id, top in ((0, 10), (1, 20), (1, 20), (0, 10)):
        write(spark.range(top), batch_id)
    assert spark.read.parquet(out).groupBy("batch_id").count().orderBy("batch_id").collect()[1]["count"] == 20
    assert spark.read.parquet(out).count() == 30


def test_idempotent_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, source, 0, 60, files=3)
    stream = read_stream(spark, "json", {"path": source}, max_per_trigger=1)
    write_idempotent(stream, out, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 60 and rows.select("batch_id").distinct().count() == 3


def test_run_is_stopped_when_its_time_is_over(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, source, 0, 30)
    run = write_stream(
        read_stream(spark, "json", {"path": source}), "parquet", {"path": out}, str(tmp_path / "c"), every="1 second"
    )
    run.processAllAvailable()
    assert run_for(run, 1) is False and not run.isActive
    assert spark.read.schema(MESSAGE_SCHEMA).parquet(out).count() == 30


def test_unmatched_messages_are_counted(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, source, 0, 90)
    stream = count_routing(read_stream(spark, "json", {"path": source}), ["LR", "SVC"])
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        run = write_stream(stream, "parquet", {"path": out}, str(tmp_path / "c"), available_now=True)
        run.awaitTermination()
        counts = [p.counts for p in log.of(run).collect()]
    assert sum(c["seen"] for c in counts) == 90 and sum(c["unmatched"] for c in counts) == 30


def test_progress_of_many_micro_batches(spark, tmp_path):
    """More micro-batches than a query remembers: every row is in the reports."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(130).selectExpr("'LR' AS key", "string(id) AS value").repartition(130, "value").write.option("maxRecordsPerFile", 1).json(source)
    with ProgressLog(spark, str(tmp_path / "progress"), every=30) as log:
        stream = read_stream(spark, "json", {"path": source}, max_per_trigger=1)
        run = write_stream(stream, "noop", {}, str(tmp_path / "c"), available_now=True)
        run.awaitTermination()
        reports = log.of(run)
        assert reports.agg(F.sum("rows"), F.countDistinct("batch_id")).first() == (130, 130)


def test_a_new_checkpoint_does_not_overwrite(spark, tmp_path):
    out = str(tmp_path / "out")
    for n in (1, 2):
        source = str(tmp_path / f"in{n}")
        put(spark, source, 0, 5 * n)
        write_idempotent(read_stream(spark, "json", {"path": source}), out, str(tmp_path / f"c{n}"), available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == 15


def test_each_stream_with_its_own_schema(spark, tmp_path):
    """One stream brings most of the messages; keys are not names; unknown keys are left out."""
    head = "uuid string, currentTime string, result int"
    rows = [(i % 2, i // 2 % 2, float(i)) for i in range(120)]
    frames = {
        "press": spark.createDataFrame(
            [(f"h{i}", "t", y, i % 3, c, y * 9.0 + i / 1000, x) for i, (y, c, x) in enumerate(rows)],
            f"{head}, mode int, lid int, heat double, flow double",
        ).coalesce(1),
        "wash": spark.createDataFrame(
            [(f"c{i}", "t", y, c, y * 4.0 + i / 1000) for i, (y, c, x) in enumerate(rows[:40])],
            f"{head}, grade int, weight double",
        ).coalesce(1),
    }
    def texts(key, cats, sensors):
        record = F.struct(
            "uuid", "currentTime", "result", F.struct(*cats).alias("categories"), F.struct(*sensors).alias("sensors")
        )
        return frames[key].select(F.lit(key).alias("key"), F.to_json(record).alias("value"))

    messages = texts("press", ["mode", "lid"], ["heat", "flow"]).unionByName(
        texts("wash", ["grade"], ["weight"])
    )
    fit_per_stream(frames, STREAMS, str(tmp_path / "models"), messages=messages)
    registry = load_registry(STREAMS, str(tmp_path / "models"))
    for cfg in STREAMS:
        # the stages of one scan are those that the records themselves give
        plan, ours = column_plan(cfg), registry[cfg.key].features
        theirs = build_pipeline(plan).fit(frames[cfg.key])
        assert list(ours.stages[0].categorySizes) == list(theirs.stages[0].categorySizes)
        for end in ("originalMin", "originalMax"):
            assert list(getattr(ours.stages[2], end)) == list(getattr(theirs.stages[2], end))
    with pytest.raises(ValueError, match="press: 121 records"):
        fit_stages(messages.unionByName(spark.createDataFrame([("press", "{}")], MESSAGE_SCHEMA)), STREAMS)
    strange = spark.createDataFrame([("pressing", "{}"), (None, "x")], MESSAGE_SCHEMA)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    messages.unionByName(strange).repartition(3).write.json(source)
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        stream = multi_schema_results(read_stream(spark, "json", {"path": source}, max_per_trigger=1), registry)
        run = write_idempotent(stream, out, str(tmp_path / "c"), available_now=True)
        run.awaitTermination()
        reports = log.of(run).collect()
    assert sum(p.rows for p in reports) == 162
    assert sum(p.counts["unmatched"] for p in reports) == 2

    plain = spark.read.schema(MESSAGE_SCHEMA).json(source)
    fields = RESULT.replace("CurrentTime", "currentTime")
    stream = parse_json(spark.read.parquet(out).select("key", "value"), fields).select("data.*")
    ways = [
        stream,
        score_multi_schema(plain, registry),
        score_variant(plain, registry),
        score_multi_schema(stage_by_key(plain, list(registry), str(tmp_path / "staged")), registry),
    ]
    bad = [("press", "{"), ("wash", '{"uuid": "u", "categories": {"grade": 0}, "sensors": {"weight": null}}'), ("wash", '{"categories": {"grade": 7}, "sensors": {"weight": 1.0}}')]
    spoiled = plain.unionByName(spark.createDataFrame(bad, MESSAGE_SCHEMA))
    assert score_variant(spoiled, registry, "skip").count() == 160
    with pytest.raises(Exception, match="cannot be scored"):
        score_variant(spoiled, registry).collect()
    got = [sorted((r.key, r.uuid, r.label, r.prediction) for r in way.collect()) for way in ways]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == 160
    assert all(label == prediction for _, _, label, prediction in got[0])


def test_sources_that_need_a_connector(spark):
    """The options are passed on; without its jar Spark does not find the source."""
    with pytest.raises(Exception, match="(?i)kafka"):
        read_stream(spark, options={"kafka.bootstrap.servers": "localhost:1", "subscribe": "t"}, max_per_trigger=5)
    with pytest.raises(Exception, match="(?i)mongodb"):
        read_documents(spark, "", fmt="mongodb", connection="none")


def failing_once(spark, start):
    with pytest.raises(Exception):
        start().awaitTermination()


def test_row_writer_refuses_what_it_has_closed(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    put(spark, source, 0, 200, files=6)

    def line(row):
        return row.value

    def fails(row):
        if row.key == "NONE" and '"u101"' in row.value:
            raise RuntimeError("gone")
        return row.value

    def run(f):
        stream = read_stream(spark, "json", {"path": source})
        return write_rows(stream, row_writer(f"file://{out}", f), checkpoint, available_now=True)

    failing_once(spark, lambda: run(fails))
    run(line).awaitTermination()
    texts = [r.value for r in read_rows(spark, out).collect()]
    assert len(texts) == len(set(texts)) == 200

    writer = row_writer(f"file://{tmp_path}/single", line)
    assert writer.open(0, 5)
    writer.process(spark.createDataFrame([("k", "v")], MESSAGE_SCHEMA).first())
    writer.close(RuntimeError("lost"))
    assert writer.open(0, 5)
    writer.close(None)
    assert not writer.open(0, 5) and writer.open(1, 5) and writer.open(0, 6)


def test_a_reader_sees_whole_published_batches_only(spark, tmp_path):
    source, out, checkpoint = (f"file://{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    stream = lambda: read_stream(spark, "json", {"path": source}, max_per_trigger=1)
    put(spark, source, 0, 90, files=1)
    write_published(stream(), out, checkpoint, available_now=True).awaitTermination()
    assert read_published(spark, out, MESSAGE_SCHEMA).count() == 90
    put(spark, source, 90, 200, files=1)
    failing_once(spark, lambda: write_published(stream(), out, checkpoint, available_now=True, fail_batch=1))
    # the second batch was written by its tasks, and nothing of it is there
    assert read_published(spark, out, MESSAGE_SCHEMA).count() == 90
    # a file of a batch that is still being written
    spark.createDataFrame([("k", "v")], MESSAGE_SCHEMA).write.parquet(f"{out}/data/running")
    assert read_published(spark, out, MESSAGE_SCHEMA).count() == 90
    write_published(stream(), out, checkpoint, available_now=True).awaitTermination()
    assert read_published(spark, out, MESSAGE_SCHEMA).distinct().count() == 200
    # another query publishes beside it
    write_published(stream(), out, checkpoint + "2", available_now=True).awaitTermination()
    assert read_published(spark, out, MESSAGE_SCHEMA).count() == 400


def test_a_batch_that_was_published_is_not_published_again(tmp_path):
    writer = published_sink()({"path": f"file://{tmp_path}", "owner": "q"}).streamWriter(None, False)
    batch = lambda v: iter([pa.RecordBatch.from_pydict({"value": [v]})])
    writer.commit([writer.write(batch("a"))], 0)
    writer.commit([writer.write(batch("b"))], 0)
    writer.abort([writer.write(batch("c")), None], 1)
    files = [p for p in tmp_path.rglob("*.parquet")]
    assert len(files) == 1 and len(list(tmp_path.glob("manifests/*"))) == 1


def test_results_and_dead_letters_are_the_input(spark, job):
    stages, models = job
    good = [(k, message(r[0], r[3:5], r[5:7], r[2])) for k, r in zip(("LR", "SVC") * 50, small_records())]
    bad = [
        ("LR", "{", "malformed"),
        ("SVC", None, "malformed"),
        ("none", "{}", "unknown key"),
        (None, "x", "unknown key"),
        ("LR", message("n", [0, None], [1.0, 2.0]), "null value"),
        ("LR", message("n", [0, 0], [float("nan"), 2.0]), "not a number"),
        ("SVC", message("n", [0, 9], [1.0, 2.0]), "unseen category"),
    ]
    messages = spark.createDataFrame(good + [b[:2] for b in bad], MESSAGE_SCHEMA)
    rows = score_or_reject(messages, stages, models, SMALL).collect()
    rejected = sorted((repr(r.key), repr(r.value), r.reason) for r in rows if r.output == "rejected")
    assert rejected == sorted((repr(k), repr(v), reason) for k, v, reason in bad)
    results = spark.createDataFrame([(r.value,) for r in rows if r.output == "result"], "value string")
    got = parse_json(results, RESULT).select("data.*")
    want = score_multi_model(spark.createDataFrame(good, MESSAGE_SCHEMA), stages, models, SMALL)
    both = [sorted((r.key, r.uuid, r.label, r.prediction) for r in x.collect()) for x in (got, want)]
    assert both[0] == both[1] and len(both[0]) == 100
    # fixed scales take any code
    fixed = score_or_reject(messages, SMALL, models, SMALL)
    assert fixed.filter("output = 'rejected'").count() == 6


def test_each_row_meets_its_own_model_only(spark, job):
    stages, models = job
    rows = [(k, message(r[0], r[3:5], r[5:7], r[2])) for k, r in zip(("LR", "SVC") * 50, small_records())]
    scored = score_multi_model(spark.createDataFrame(rows, MESSAGE_SCHEMA), stages, models, SMALL)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    # no column holds a model's margins for all rows: they stand in the branches of the key
    assert "AS _raw" not in plan
    parts = [model.transform(feature_table(spark.createDataFrame(small_records(), RECORD_SCHEMA), stages, column_plan(SMALL))).select(F.lit(k).alias("key"), "uuid", "prediction", "rawPrediction") for k, model in models.items()]
    want = {(r.key, r.uuid): (r.prediction, list(r.rawPrediction)) for r in union_all(*parts).collect()}
    assert all(want[r.key, r.uuid] == (r.prediction, list(r.rawPrediction)) for r in scored.collect())

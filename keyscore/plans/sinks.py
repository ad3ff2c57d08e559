"""Sinks over whole test tables, read back after writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyscore.functions.scalar import emit_json
from keyscore.operators.evaluation import report_rows
from keyscore.operators.features import build_pipeline, feature_table, fixed_layout
from keyscore.operators.routing import union_all
from keyscore.operators.scoring import score_linear
from keyscore.operators.training import fit_logreg
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.plans.scans import drain, identities, labelled, run_to_failure
from keyscore.records import ENDPOINT, MESSAGE_SCHEMA, column_plan
from keyscore.sources.registry import artefact_path, load_model, save_model
from keyscore.sources.sinks import REPORT_SCHEMA, preview, to_feature_csv, to_messages, to_svmlight, write_report, write_train_test
from keyscore.sources.streams import read_stream
from keyscore.storage import fresh_path, shared
from keyscore.streaming.outputs import read_published, read_rows, row_writer, write_published, write_rows


def _stream(spark, sf_dir):
    path = ep.stage(ep.messages(spark, sf_dir), "messages")
    return read_stream(spark, "json", {"path": path}, max_bytes=ep.BATCH_BYTES)


@query("sink_kafka_append", f"WITH {ep.EP} SELECT key, uuid, Result, sensor0 FROM ep")
def sink_kafka_append(spark, sf_dir):
    rows, _ = drain(_stream(spark, sf_dir), "appended")
    return identities(rows)


def _line(row):
    """The text of a message; a function of its own, so that it travels with the writer."""
    import json

    return json.dumps([row.key, row.value])


@query("sink_foreach", f"WITH {ep.EP} SELECT key, uuid, Result, sensor0 FROM ep")
def sink_foreach(spark, sf_dir):
    """A row writer fails in the middle of an epoch, after some of its partitions are closed; the epoch is replayed, and
    those partitions refuse to be opened again."""
    path = ep.stage(ep.messages(spark, sf_dir).repartition(8, "value"), "messages")
    out, checkpoint = fresh_path(spark, "foreach"), fresh_path(spark, "checkpoint")

    def run(line):
        stream = read_stream(spark, "json", {"path": path}, max_bytes=ep.BATCH_BYTES)
        return write_rows(stream, row_writer(out, line), checkpoint, available_now=True)

    def fails(row):
        import json

        if json.loads(row.value)["uuid"].endswith("77"):
            raise RuntimeError("the writer is gone")
        return json.dumps([row.key, row.value])

    run_to_failure(lambda: run(fails))
    run(_line).awaitTermination()
    pair = F.from_json("value", "array<string>")
    return identities(read_rows(spark, out).select(pair[0].alias("key"), pair[1].alias("value")))


@query("sink_exactly_once", f"WITH {ep.EP} SELECT key, uuid, Result, sensor0 FROM ep")
def sink_exactly_once(spark, sf_dir):
    """The first micro-batch is lost between its tasks' commits and its publication. A reader sees none of it; replayed,
    each row is there once."""
    out, checkpoint = fresh_path(spark, "published"), fresh_path(spark, "checkpoint")
    path = ep.stage(ep.messages(spark, sf_dir), "messages")

    def run(**more):
        stream = read_stream(spark, "json", {"path": path}, max_bytes=ep.BATCH_BYTES)
        return write_published(stream, out, checkpoint, available_now=True, **more)

    run_to_failure(lambda: run(fail_batch=0))
    run().awaitTermination()
    return identities(read_published(spark, out, MESSAGE_SCHEMA))


@query(
    "sink_topic_message",
    f"""WITH {ep.EP}, p AS (SELECT *, CASE WHEN {ep.linear_sql(ep.LINEAR_COLUMNS, ep.LINEAR_WEIGHTS, ep.LINEAR_INTERCEPT)} > 0
        THEN 1 ELSE 0 END AS prediction FROM ep)
      SELECT 'results' AS topic, key,
      '{{"key":"' || key || '","uuid":"' || uuid || '","recordTime":"' || CurrentTime || '","prediction":' || prediction || '}}' AS value
      FROM p""",
)
def sink_topic_message(spark, sf_dir):
    """Thin results of the fixed linear model as messages."""
    scored = score_linear(ep.endpoints(spark, sf_dir), ep.LINEAR_COLUMNS, ep.LINEAR_WEIGHTS, ep.LINEAR_INTERCEPT, "margin")
    thin = scored.select("key", "uuid", F.col("CurrentTime").alias("recordTime"), "prediction")
    return to_messages(emit_json(thin), "results")


@query(
    "sink_console",
    f"WITH {ep.EP} SELECT uuid, key, CurrentTime, Result FROM ep ORDER BY sensor0 DESC, uuid LIMIT 10",
)
def sink_console(spark, sf_dir):
    rows = ep.endpoints(spark, sf_dir).select("uuid", "key", "CurrentTime", "Result", "sensor0")
    return preview(rows, 10, [F.desc("sensor0"), F.asc("uuid")]).drop("sensor0")


_texts = [f"printf('%.3f', f{i})" for i in range(len(ep.SENSORS))]
_texts += [f"CAST(CAST(f{i} AS INT) AS VARCHAR)" for i in range(len(ep.SENSORS), ep.WIDTH)]
_csv_line = " || ', ' || ".join(_texts) + " || ', ' || Result"
_svm_line = "Result || ' ' || " + " || ' ' || ".join(f"'{i}:' || {t}" for i, t in enumerate(_texts)) + " || ' '"


@query("sink_csv", f"WITH {ep.SLOTS} SELECT {_csv_line} AS line FROM slots")
def sink_csv(spark, sf_dir):
    path = ep.stage(to_feature_csv(labelled(spark, sf_dir), ENDPOINT), "csv", fmt="text")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("sink_svmlight", f"WITH {ep.SLOTS} SELECT {_svm_line} AS line FROM slots")
def sink_svmlight(spark, sf_dir):
    path = ep.stage(to_svmlight(labelled(spark, sf_dir), ENDPOINT), "svmlight", fmt="text")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "sink_train_test_files",
    f"""WITH {ep.SLOTS}, r AS (SELECT *, CASE WHEN (row_number() OVER (ORDER BY CAST(uuid AS BIGINT)) - 1) % 5 = 0 THEN 'test' ELSE 'train' END AS part FROM slots)
      SELECT 'svm' AS format, part, {_svm_line} AS line FROM r UNION ALL SELECT 'csv', part, {_csv_line} FROM r""",
)
def sink_train_test_files(spark, sf_dir):
    """Train and test files in both formats from one ordered split, as text and through their readers."""
    wide = fixed_layout(ep.endpoints(spark, sf_dir), ENDPOINT, vector=False)
    rows = wide.select(F.col("uuid").cast("long").alias("position"), F.col("Result").alias("label"), "features")
    paths = write_train_test(rows, ["position"], ENDPOINT, fresh_path(spark, "split-files"))
    found = [spark.read.text(p).select(F.lit(f).alias("format"), F.lit(part).alias("part"), F.col("value").alias("line")) for (f, part), p in paths.items()]
    return union_all(*found)


@query(
    "sink_model_save",
    f"WITH {ep.EP} SELECT key, count(*) AS scored, count(*) AS same FROM ep GROUP BY key",
)
def sink_model_save(spark, sf_dir):
    """Feature stages and a model saved, read back and applied: rows scored alike, by key."""
    plan, base = column_plan(ENDPOINT), fresh_path(spark, "models")
    flat = ep.endpoints(spark, sf_dir).drop("event_type")
    stages = build_pipeline(plan).fit(flat)
    save_model(stages, artefact_path(base, "pipeline", "epd"))
    with shared(feature_table(flat, stages, plan)) as rows:
        model = fit_logreg(rows)
        save_model(model, artefact_path(base, "lr", "epd"))
    again = load_model("lr", artefact_path(base, "lr", "epd")).setPredictionCol("again").setRawPredictionCol("")
    table = feature_table(flat, load_model("pipeline", artefact_path(base, "pipeline", "epd")), plan)
    both = again.setProbabilityCol("").transform(model.transform(table))
    return both.groupBy("key").agg(
        F.count("again").alias("scored"), F.count_if(F.col("again") == F.col("prediction")).alias("same")
    )


@query(
    "sink_eval_report",
    f"""WITH {ep.PR}, s AS (SELECT event_type AS stream, avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END) AS accuracy,
        (avg(CASE WHEN label = 1 THEN prediction END) + avg(CASE WHEN label = 0 THEN 1 - prediction END)) / 2 AS auc,
        count(*) AS n FROM pr GROUP BY event_type)
      SELECT stream, 'linear' AS model, 'accuracy' AS metric, round(accuracy, 9) AS value FROM s
      UNION ALL SELECT stream, 'linear', 'auc', round(auc, 9) FROM s
      UNION ALL SELECT stream, 'linear', 'rows', CAST(n AS DOUBLE) FROM s""",
)
def sink_eval_report(spark, sf_dir):
    path = fresh_path(spark, "report")
    write_report(report_rows(ep.predictions(spark, sf_dir), F.col("event_type"), "linear"), path)
    return spark.read.schema(REPORT_SCHEMA).json(path).withColumn("value", F.round("value", 9))

"""Sources over whole test tables: each query writes the reader's format, then reads it back."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from keyscore.functions.scalar import parse_json
from keyscore.operators.features import fixed_layout
from keyscore.operators.projection import expand, flatten, map_columns
from keyscore.operators.routing import union_all
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.records import ENDPOINT, endpoint_map_schema, endpoint_schema
from keyscore.sources.config import config_tables, load_config
from keyscore.sources.documents import read_documents, read_feature_csv, read_svm_model, read_svmlight
from keyscore.sources.sinks import write_feature_csv, write_svmlight
from keyscore.sources.streams import read_stream, with_kafka_meta
from keyscore.storage import fresh_path
from keyscore.streaming.jobs import ProgressLog, write_stream

FLAT = f"SELECT uuid, CurrentTime, Result, {', '.join(ep.CATS + ep.SENSORS)} FROM ep"


@query("src_document_scan", f"WITH {ep.EP} {FLAT}")
def src_document_scan(spark, sf_dir):
    path = ep.stage(ep.documents(spark, sf_dir), "documents")
    flat = flatten(read_documents(spark, path, "json"), ["Categories", "Sensors"], ["uuid", "CurrentTime", "Result"])
    # inferred integers are long
    return flat.withColumns({c: F.col(c).cast("int") for c in ("Result", *ep.CATS)})


@query("src_typed_collection", f"WITH {ep.EP} {FLAT}")
def src_typed_collection(spark, sf_dir):
    path = ep.stage(ep.documents(spark, sf_dir), "documents")
    docs = read_documents(spark, path, "json", schema=endpoint_map_schema())
    wide = map_columns(map_columns(docs, "Categories", "cat", len(ep.CATS)), "Sensors", "sensor", len(ep.SENSORS))
    return wide.drop("Topic", "Categories", "Sensors")


# --- streams of messages, read from files ---------------------------------------------------


def drain(df, name):
    """Run a stream over all that its source holds and return what reached the sink."""
    spark = df.sparkSession
    out = fresh_path(spark, name)
    query = write_stream(df, "parquet", {"path": out}, fresh_path(spark, "checkpoint"), available_now=True)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out), query


def run_to_failure(start):
    """Start a query that must fail, and wait until it has."""
    try:
        start().awaitTermination()
    except StreamingQueryException:
        return
    raise AssertionError("the failure was not reported")


def identities(df):
    """key, uuid, Result and one sensor of each message."""
    parsed = parse_json(df.select("key", "value"), endpoint_schema())
    return parsed.select("key", "data.uuid", "data.Result", F.col("data.Sensors.sensor0").alias("sensor0"))


@query("src_kafka_stream", f"WITH {ep.EP} SELECT key, uuid, Result, sensor0 FROM ep")
def src_kafka_stream(spark, sf_dir):
    path = ep.stage(ep.messages(spark, sf_dir), "messages")
    rows, _ = drain(read_stream(spark, "json", {"path": path}, max_bytes=ep.BATCH_BYTES), "received")
    return identities(rows)


@query(
    "src_kafka_metadata",
    f"WITH {ep.EP} SELECT key, uuid, CAST(CAST(uuid AS BIGINT) % 4 AS INT) AS partition, "
    'CAST(uuid AS BIGINT) // 4 AS "offset" FROM ep',
)
def src_kafka_metadata(spark, sf_dir):
    event = F.get_json_object("value", "$.uuid").cast("long")
    raw = ep.messages(spark, sf_dir).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.pmod(event, F.lit(4)).cast("int").alias("partition"),
        F.expr("CAST(get_json_object(value, '$.uuid') AS BIGINT) DIV 4").alias("offset"),
    )
    path = ep.stage(raw, "topic", fmt="parquet")
    stream = read_stream(spark, "parquet", {"path": path}, schema=raw.schema)
    rows, _ = drain(with_kafka_meta(stream), "received")
    return rows.select("key", F.get_json_object("value", "$.uuid").alias("uuid"), "partition", "offset")


#: Bytes of messages in a file of the stream whose rate is limited.
RATE_FILE_BYTES = 8 << 20


@query("src_rate_limit", "SELECT count(*) AS rows, true AS limit_kept FROM events")
def src_rate_limit(spark, sf_dir):
    """All rows arrive, and no micro-batch has more rows than the two largest files: two files each at most.

    The number of files follows the bytes of the messages."""
    path = fresh_path(spark, "messages")
    messages = ep.messages(spark, sf_dir)
    sizes = messages.agg(F.sum(F.octet_length("value")), F.count("*")).first()
    per_file = max(1, RATE_FILE_BYTES * sizes[1] // max(sizes[0] or 1, 1))
    messages.write.option("maxRecordsPerFile", per_file).json(path)
    with ProgressLog(spark, fresh_path(spark, "progress")) as log:
        rows, run = drain(read_stream(spark, "json", {"path": path}, max_per_trigger=2), "received")
        most = log.of(run).agg(F.max("rows")).first()[0] or 0
    return rows.agg(F.count("*").alias("rows")).withColumn("limit_kept", F.lit(most <= 2 * per_file))


# --- feature files -------------------------------------------------------------------------------

_read_back = ", ".join(
    f"CAST(printf('%.3f', f{i}) AS DOUBLE) AS f{i}" if i < len(ep.SENSORS) else f"f{i}" for i in range(ep.WIDTH)
)
FEATURE_ROWS = f"WITH {ep.SLOTS} SELECT Result AS label, {_read_back} FROM slots"


def labelled(spark, sf_dir):
    wide = fixed_layout(ep.endpoints(spark, sf_dir), ENDPOINT, vector=False)
    return wide.select(F.col("Result").alias("label"), "features")


@query("src_csv", FEATURE_ROWS)
def src_csv(spark, sf_dir):
    path = write_feature_csv(labelled(spark, sf_dir), ENDPOINT, fresh_path(spark, "csv"))
    return expand(read_feature_csv(spark, path, ep.WIDTH, vector=False), "features", ep.WIDTH)


@query("src_svmlight", FEATURE_ROWS)
def src_svmlight(spark, sf_dir):
    path = write_svmlight(labelled(spark, sf_dir), ENDPOINT, fresh_path(spark, "svmlight"))
    return expand(read_svmlight(spark, path, ep.WIDTH, vector=False), "features", ep.WIDTH)


@query(
    "src_svm_model",
    """SELECT CASE WHEN label % 2 = 0 THEN 1e0 ELSE -1e0 END AS coef, 64 AS dim, 0.015625e0 AS gamma, 0.25e0 AS rho,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total,
       CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[64] AS DOUBLE) AS last,
       (SELECT count(*) FROM embeddings) AS total_sv
       FROM embeddings""",
)
def src_svm_model(spark, sf_dir):
    """A model file whose support vectors are all embeddings: even labels positive, odd negative."""
    rows = ep.table(spark, sf_dir, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("v"))
    pairs = F.transform("v", lambda x, i: F.concat(i.cast("string"), F.lit(":"), x.cast("string")))
    coef = F.when(F.col("label") % 2 == 0, "1.0").otherwise("-1.0")
    lines = rows.select(F.concat_ws(" ", coef, F.concat_ws(" ", pairs), F.lit("")).alias("line"))
    n = rows.agg(F.count_if(F.col("label") % 2 == 0).alias("even"), F.count_if(F.col("label") % 2 == 1).alias("odd")).first()
    head = [
        "svm_type c_svc", "kernel_type rbf", "gamma 0.015625", "nr_class 2", f"total_sv {n.even + n.odd}",
        "rho 0.25", "label 0 1", f"nr_sv {n.even} {n.odd}", "SV",
    ]
    header = spark.createDataFrame([(line,) for line in head], "line string").coalesce(1)
    path = ep.stage(union_all(header, lines), "svm-model", fmt="text")
    params, vectors = read_svm_model(spark, path)
    v = F.col("vector")
    return vectors.select(
        "coef",
        F.size(v).alias("dim"),
        F.lit(params.gamma).alias("gamma"),
        F.lit(params.rho).alias("rho"),
        F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        v[0].alias("first"),
        F.element_at(v, -1).alias("last"),
        F.lit(params.total_sv).cast("long").alias("total_sv"),
    )


# --- configuration ----------------------------------------------------------------------------------


def config_folder(spark):
    """The five streams as configuration files (JSON, which is YAML too)."""
    configs = ep.stream_configs()
    folder = fresh_path(spark, "config")
    master = {
        "config": [
            {"equipName": c.key, "fileName": f"{c.key}01", "taktTime": 2000, "offsetDelay": 300,
             "consumerTopic": c.consumer_topic, "producerTopic": c.producer_topic}
            for c in configs
        ]
    }
    texts = {"streams.yml": master}
    for c in configs:
        texts[f"{c.key}01.yml"] = {
            "name": c.name, "err": 0.1, "success": 0.5, "alrt": [],
            "cont": [asdict(s) for s in c.cont], "disc": [asdict(d) for d in c.disc],
        }
    for name, body in texts.items():
        text = spark.createDataFrame([(json.dumps(body, indent=1),)], "value string").coalesce(1)
        text.write.text(f"{folder}/{name}")
    return folder


def _config_rows() -> str:
    rows = []
    for c in ep.stream_configs():
        cats, sensors = ep.STREAMS[c.key][1:]
        for part, items, sources in (("cont", c.cont, sensors), ("disc", c.disc, cats)):
            for item in items:
                width = item.num if part == "disc" else 1
                rows.append(
                    f"SELECT '{c.key}' AS key, '{c.name}' AS stream, '{part}' AS part, '{item.name}' AS name, "
                    f"CAST({item.id} AS INT) AS id, CAST({width} AS INT) AS width, count(*) AS records, "
                    f"CAST(min({sources[item.name]}) AS DOUBLE) AS lo, CAST(max({sources[item.name]}) AS DOUBLE) AS hi "
                    f"FROM ep WHERE event_type = '{c.key}'"
                )
    return " UNION ALL ".join(rows)


@query("src_config_tables", f"WITH {ep.EP} {_config_rows()}")
def src_config_tables(spark, sf_dir):
    """Configured fields of every stream beside what its messages hold for them."""
    tables = config_tables(spark, load_config(spark, config_folder(spark), "streams.yml"))
    declared = union_all(
        tables["cont"].select("key", F.lit("cont").alias("part"), "name", "id", F.lit(1).alias("width")),
        tables["disc"].select("key", F.lit("disc").alias("part"), "name", "id", F.col("num").alias("width")),
    ).join(tables["stream"].select("key", F.col("name").alias("stream")), "key")
    schema = "categories map<string,double>, sensors map<string,double>"
    fields = parse_json(ep.stream_messages(spark, sf_dir), schema).select(
        "key", F.explode(F.map_concat("data.categories", "data.sensors")).alias("name", "v")
    )
    seen = fields.groupBy("key", "name").agg(
        F.count("*").alias("records"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    # the configuration has one row per declared field, and Spark sees its size
    return seen.join(declared, ["key", "name"]).select(
        "key", "stream", "part", "name", "id", "width", "records", "lo", "hi"
    )

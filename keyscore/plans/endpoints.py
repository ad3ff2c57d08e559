"""Endpoint records derived from the test tables, in Spark and as SQL text.

``events`` becomes the fixed-schema endpoint record (8 categories, 10 sensors): its event id is
the uuid, one key in five matches no model, and 1 label in 17 is flipped. The same events become
five streams of their own schema, keyed by event type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.functions.scalar import emit_json, weighted_sum
from keyscore.operators.features import fixed_layout
from keyscore.operators.projection import expand
from keyscore.records import ENDPOINT, Category, Sensor, StreamConfig
from keyscore.storage import fresh_path

CATS = ENDPOINT.categories
SENSORS = ENDPOINT.sensors
WIDTH = ENDPOINT.width


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- the endpoint view ------------------------------------------------------------------

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
KEY = (
    "CASE event_id % 5 WHEN 0 THEN 'LR' WHEN 1 THEN 'SVC' WHEN 2 THEN 'RF' WHEN 3 THEN 'GBT' ELSE 'NONE' END"
)
EVENT_CODE = (
    "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"
)

# column -> expression that Spark and DuckDB both read
ENDPOINT_COLUMNS = {
    "uuid": "CAST(event_id AS STRING)",
    "CurrentTime": "substring(CAST(ts AS STRING), 1, 19)",
    "key": KEY,
    "event_type": "event_type",
    "Result": "CASE WHEN (value > 50) <> (event_id % 17 = 0) THEN 1 ELSE 0 END",
    "cat0": "CAST(user_id % 2 AS INT)",
    "cat1": EVENT_CODE,
    "cat2": f"{K} % 4",
    "cat3": "CAST(hour(ts) % 3 AS INT)",
    "cat4": "CAST(user_id % 4 >= 2 AS INT)",
    "cat5": "CAST(user_id % 5 AS INT)",
    "cat6": f"({K} + CAST(user_id % 4 AS INT)) % 4",
    "cat7": "CAST(minute(ts) % 3 AS INT)",
    "sensor0": "value",
    "sensor1": f"CAST({K} AS DOUBLE)",
    "sensor2": "CAST(hour(ts) AS DOUBLE)",
    "sensor3": "CAST(user_id AS DOUBLE)",
    "sensor4": "CAST(minute(ts) AS DOUBLE)",
    "sensor5": "CAST(second(ts) AS DOUBLE)",
    "sensor6": "CAST(day(ts) AS DOUBLE)",
    "sensor7": "CAST(user_id % 50 AS DOUBLE)",
    "sensor8": f"CAST({K} - 50 AS DOUBLE)",
    "sensor9": f"CAST((user_id + {K}) % 97 AS DOUBLE)",
}


#: Rows below which a task of its own does not pay, and the most that a task gets: a fit holds a partition's rows as objects
#: while it caches them, several tasks and several fits at a time.
ROWS_PER_TASK, MOST_ROWS = 10_000, 250_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores. A packed file of few megabytes is one task to Spark, however long its rows then keep it busy.

    Packed rows are small, so a part of the file's bytes can be millions of rows: the number of parts follows the rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts, rows = df.rdd.getNumPartitions(), df.count()
    wanted = max(min(cores, rows // ROWS_PER_TASK), -(-rows // MOST_ROWS))
    return df.repartition(wanted) if wanted > parts else df


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat endpoint records."""
    return spread(table(spark, sf_dir, "events")).selectExpr(*[f"{e} AS {c}" for c, e in ENDPOINT_COLUMNS.items()])


_columns_sql = ",\n  ".join(f"{e} AS {c}" for c, e in ENDPOINT_COLUMNS.items())
EP = f"ep AS (SELECT\n  {_columns_sql}\n FROM events)"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records nested: Categories and Sensors as structs."""
    return endpoints(spark, sf_dir).select(
        "uuid",
        "CurrentTime",
        F.lit("epd").alias("Topic"),
        "Result",
        F.struct(*CATS).alias("Categories"),
        F.struct(*SENSORS).alias("Sensors"),
        "key",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, value messages of the one-schema stream."""
    docs = documents(spark, sf_dir)
    return emit_json(docs, [c for c in docs.columns if c != "key"])


# --- features with fixed scales ---------------------------------------------------------------


def slots(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Fixed-layout features as columns f0 .. f29 after the record's other columns."""
    wide = fixed_layout(df, ENDPOINT, vector=False).drop(*CATS, *SENSORS)
    return expand(wide, "features", WIDTH, digits=digits)


def fixed_slot_sql() -> list[str]:
    out = [f"{s} / CAST({d!r} AS DOUBLE)" for s, d in zip(SENSORS, ENDPOINT.divisors)]
    for c, size in zip(CATS, ENDPOINT.sizes):
        out += [f"CASE WHEN {c} = {level} THEN 1e0 ELSE 0e0 END" for level in range(1, size)]
    return out


_slots_sql = ", ".join(f"{e} AS f{i}" for i, e in enumerate(fixed_slot_sql()))
SLOTS = f"{EP}, slots AS (SELECT uuid, CurrentTime, key, event_type, Result, {_slots_sql} FROM ep)"


def slot_list(prefix: str = "f", digits: int | None = None) -> str:
    if digits is None:
        return ", ".join(f"{prefix}{i}" for i in range(WIDTH))
    return ", ".join(f"round({prefix}{i}, {digits}) AS {prefix}{i}" for i in range(WIDTH))


def learned_slot_sql() -> list[str]:
    """Drop-last indicators, then raw sensors: the layout of the learned feature stages."""
    out = []
    for c, size in zip(CATS, ENDPOINT.sizes):
        out += [f"CASE WHEN {c} = {level} THEN 1e0 ELSE 0e0 END" for level in range(size - 1)]
    return out + list(SENSORS)


_learned_sql = ", ".join(f"{e} AS f{i}" for i, e in enumerate(learned_slot_sql()))
LEARNED = f"{EP}, learned AS (SELECT uuid, CurrentTime, key, Result, {_learned_sql} FROM ep)"
_span_sql = ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(WIDTH))
_scaled_sql = ", ".join(
    f"CASE WHEN hi{i} = lo{i} THEN 0.5e0 ELSE (f{i} - lo{i}) / (hi{i} - lo{i}) END AS f{i}" for i in range(WIDTH)
)
SCALED = (
    f"{LEARNED}, span AS (SELECT {_span_sql} FROM learned), "
    f"scaled AS (SELECT uuid, CurrentTime, key, Result, {_scaled_sql} FROM learned, span)"
)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with fixed scales: uuid, key, label, features."""
    wide = fixed_layout(endpoints(spark, sf_dir), ENDPOINT, vector=True)
    return wide.select("uuid", "CurrentTime", "key", F.col("Result").alias("label"), "features")


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


# --- a fixed linear model, whose predictions the evaluation queries use --------------------------

LINEAR_COLUMNS = ("sensor0", "sensor1", "sensor2", "sensor3", "cat0", "cat3")
LINEAR_WEIGHTS = (0.08, -0.004, 0.01, -0.0005, 0.1, -0.07)
LINEAR_INTERCEPT = -3.6


def linear_sql(columns, weights, intercept: float) -> str:
    out = "0e0"
    for c, w in zip(columns, weights):
        out = f"({out} + {c} * CAST({float(w)!r} AS DOUBLE))"
    return f"({out} + CAST({float(intercept)!r} AS DOUBLE))"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uuid, key, label, score, prediction of the fixed linear model."""
    margin = weighted_sum([F.col(c) for c in LINEAR_COLUMNS], LINEAR_WEIGHTS, LINEAR_INTERCEPT)
    rows = endpoints(spark, sf_dir).select(
        "uuid", "key", "event_type", F.col("Result").alias("label"), margin.alias("score")
    )
    return rows.withColumn("prediction", (F.col("score") > 0).cast("int"))


PR = (
    f"{EP}, pr0 AS (SELECT uuid, key, event_type, Result AS label, "
    f"{linear_sql(LINEAR_COLUMNS, LINEAR_WEIGHTS, LINEAR_INTERCEPT)} AS score FROM ep), "
    "pr AS (SELECT *, CASE WHEN score > 0 THEN 1 ELSE 0 END AS prediction FROM pr0)"
)

# --- five streams with schemas of their own ----------------------------------------------------

# key -> (name, {category: endpoint column}, {sensor: endpoint column}); key and name may differ
STREAMS = {
    "click": ("clicker", {"discA1": "cat0", "discA2": "cat2"}, {"sensA1": "sensor0", "sensA2": "sensor1"}),
    "error": (
        "error",
        {"discB1": "cat2", "discB2": "cat3", "discB3": "cat5"},
        {"sensB1": "sensor0", "sensB2": "sensor2", "sensB3": "sensor4"},
    ),
    "purchase": ("buyer", {"discC1": "cat3"}, {"sensC1": "sensor0", "sensC2": "sensor5"}),
    "signup": (
        "signup",
        {"discD1": "cat0", "discD2": "cat7"},
        {"sensD1": "sensor0", "sensD2": "sensor8", "sensD3": "sensor9"},
    ),
    "view": ("viewer", {"discE1": "cat6", "discE2": "cat4"}, {"sensE1": "sensor0", "sensE2": "sensor7"}),
}
_SIZE = dict(zip(CATS, ENDPOINT.sizes))


def stream_configs() -> list[StreamConfig]:
    configs = []
    for i, (key, (name, cats, sensors)) in enumerate(STREAMS.items()):
        disc = tuple(
            Category(id=10 * i + j, name=c, num=_SIZE[source], levels=", ".join(f"l{x}" for x in range(_SIZE[source])))
            for j, (c, source) in enumerate(cats.items())
        )
        cont = tuple(Sensor(id=10 * i + 5 + j, name=s, max=600.0, min=-50.0, dist="uni") for j, s in enumerate(sensors))
        configs.append(StreamConfig(key=key, name=name, cont=cont, disc=disc, consumer_topic=key, producer_topic="hub"))
    return configs


def stream_records(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Flat training records of one stream."""
    _, cats, sensors = STREAMS[key]
    rows = endpoints(spark, sf_dir).filter(F.col("event_type") == key)
    renamed = [F.col(source).alias(name) for name, source in {**cats, **sensors}.items()]
    return rows.select("uuid", F.col("CurrentTime").alias("currentTime"), F.col("Result").alias("result"), *renamed)


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, value messages of all five streams, each in its own schema."""
    rows = endpoints(spark, sf_dir)

    def text(cats, sensors):
        return F.to_json(
            F.struct(
                "uuid",
                F.col("CurrentTime").alias("currentTime"),
                F.col("Result").alias("result"),
                F.struct(*[F.col(s).alias(c) for c, s in cats.items()]).alias("categories"),
                F.struct(*[F.col(s).alias(c) for c, s in sensors.items()]).alias("sensors"),
            )
        )

    value = reduce(
        lambda chain, item: chain.when(F.col("event_type") == item[0], text(*item[1][1:])), STREAMS.items(), F
    )
    return rows.select(F.col("event_type").alias("key"), value.alias("value"))


# --- staging ----------------------------------------------------------------------------------


def stage(df: DataFrame, name: str, fmt: str = "json") -> str:
    """Write a table to the shared folder, one file per partition."""
    path = fresh_path(df.sparkSession, name)
    df.write.format(fmt).save(path)
    return path


# The most that a micro-batch of a stream over staged files takes, whatever the size of the input.
BATCH_BYTES = 64 << 20

"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyscore.functions.scalar import argmax2, emit_json, feature_array, fmt, logistic, parse_json, round_label, scale
from keyscore.operators.projection import flatten
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.records import ENDPOINT, endpoint_schema

_flat = ", ".join(ep.CATS + ep.SENSORS)


@query("json_parse", f"WITH {ep.EP} SELECT key, uuid, CurrentTime, Result, {_flat} FROM ep")
def json_parse(spark, sf_dir):
    parsed = parse_json(ep.messages(spark, sf_dir), endpoint_schema())
    return flatten(
        parsed, ["data.Categories", "data.Sensors"], ["key", "data.uuid", "data.CurrentTime", "data.Result"]
    )


@query("json_emit", f"WITH {ep.EP} SELECT key, uuid, Result, cat1, sensor0, sensor8 FROM ep")
def json_emit(spark, sf_dir):
    """Emitted text, read by path rather than by schema."""
    text = emit_json(ep.documents(spark, sf_dir))
    path = lambda p, kind: F.get_json_object("value", p).cast(kind)
    return text.select(
        "key",
        path("$.uuid", "string").alias("uuid"),
        path("$.Result", "int").alias("Result"),
        path("$.Categories.cat1", "int").alias("cat1"),
        path("$.Sensors.sensor0", "double").alias("sensor0"),
        path("$.Sensors.sensor8", "double").alias("sensor8"),
    )


@query(
    "str_split",
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INT) AS tokens, string_split(text, ' ')[1] AS head, "
    "string_split(string_split(text, ' ')[1], ':')[1] AS before_colon FROM documents",
)
def str_split(spark, sf_dir):
    """Whole texts split on blanks, tokens on colons."""
    tokens = F.split("text", " ", -1)
    head = F.element_at(tokens, 1)
    return ep.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(tokens).alias("tokens"),
        head.alias("head"),
        F.element_at(F.split(head, ":", -1), 1).alias("before_colon"),
    )


@query("str_format3", f"WITH {ep.EP} SELECT uuid, printf('%.3f', sensor0 / 25e0) AS text FROM ep")
def str_format3(spark, sf_dir):
    return ep.endpoints(spark, sf_dir).select("uuid", fmt(scale(F.col("sensor0"), 25.0)).alias("text"))


@query(
    "str_concat",
    f"WITH {ep.EP} SELECT uuid, event_type || 'Vec' AS encoded, "
    "Result || ' ' || cat0 || ' ' || cat1 || ' ' || cat2 AS line FROM ep",
)
def str_concat(spark, sf_dir):
    return ep.endpoints(spark, sf_dir).select(
        "uuid",
        F.concat("event_type", F.lit("Vec")).alias("encoded"),
        F.concat_ws(" ", *[F.col(c).cast("string") for c in ("Result", "cat0", "cat1", "cat2")]).alias("line"),
    )


_scaled = ", ".join(f"{s} / CAST({d!r} AS DOUBLE) AS {s}" for s, d in zip(ep.SENSORS, ENDPOINT.divisors))


@query("math_fixed_scale", f"WITH {ep.EP} SELECT uuid, {_scaled} FROM ep")
def math_fixed_scale(spark, sf_dir):
    scaled = [scale(F.col(s), d).alias(s) for s, d in zip(ep.SENSORS, ENDPOINT.divisors)]
    return ep.endpoints(spark, sf_dir).select("uuid", *scaled)


@query(
    "math_round_label",
    "SELECT l_orderkey, l_discount * 10e0 AS p, CAST(floor(l_discount * 10e0 + 0.5e0) AS INT) AS label FROM lineitem",
)
def math_round_label(spark, sf_dir):
    p = F.col("l_discount") * 10.0
    return ep.table(spark, sf_dir, "lineitem").select("l_orderkey", p.alias("p"), round_label(p).alias("label"))


@query(
    "math_argmax2",
    "SELECT l_orderkey, CASE WHEN l_tax > l_discount THEN 1 ELSE 0 END AS prediction FROM lineitem",
)
def math_argmax2(spark, sf_dir):
    rows = ep.table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", argmax2(F.col("l_discount"), F.col("l_tax")).alias("prediction"))


@query(
    "arr_index",
    f"WITH {ep.PR} SELECT uuid, round(1e0 / (1e0 + exp(-score)), 9) AS p, score AS first, CAST(label AS DOUBLE) AS second FROM pr",
)
def arr_index(spark, sf_dir):
    """Positional write, then read."""
    rows = ep.predictions(spark, sf_dir)
    array = feature_array([F.col("score"), F.col("label"), logistic(F.col("score"))])
    a = rows.select("uuid", array.alias("a"))
    return a.select(
        "uuid", F.col("a")[0].alias("first"), F.element_at("a", 2).alias("second"), F.round(F.col("a")[2], 9).alias("p")
    )

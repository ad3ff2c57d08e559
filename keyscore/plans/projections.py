"""Projections, filters, routing, set operations and record functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyscore.functions.scalar import cast_kv, emit_json, parse_json
from keyscore.operators.projection import flatten, map_columns, to_feature_table
from keyscore.operators.routing import branch, fanout_rows, matched, route, union_all, unmatched
from keyscore.operators.userfn import filter_records, map_records
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.records import ENDPOINT, MODEL_KEYS, column_plan, endpoint_schema
from keyscore.sources.sinks import preview

_keys = ", ".join(f"'{k}'" for k in MODEL_KEYS)
_flat = ", ".join(ep.CATS + ep.SENSORS)


@query("proj_select", f"WITH {ep.EP} SELECT CurrentTime, Result FROM ep")
def proj_select(spark, sf_dir):
    return ep.documents(spark, sf_dir).select("CurrentTime", "Result")


@query("proj_struct_expand", f"WITH {ep.EP} SELECT uuid, {_flat} FROM ep")
def proj_struct_expand(spark, sf_dir):
    return flatten(ep.documents(spark, sf_dir), ["Categories", "Sensors"], ["uuid"])


@query("proj_map_lookup", f"WITH {ep.EP} SELECT uuid, {_flat} FROM ep")
def proj_map_lookup(spark, sf_dir):
    entries = lambda names: F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names])
    )
    docs = ep.endpoints(spark, sf_dir).select("uuid", entries(ep.CATS).alias("c"), entries(ep.SENSORS).alias("s"))
    wide = map_columns(map_columns(docs, "c", "cat", len(ep.CATS)), "s", "sensor", len(ep.SENSORS))
    return wide.drop("c", "s")


@query("proj_cast_kv", f"WITH {ep.EP} SELECT key, uuid AS value FROM ep")
def proj_cast_kv(spark, sf_dir):
    raw = ep.endpoints(spark, sf_dir).select(
        F.col("key").cast("binary").alias("key"), F.col("uuid").cast("binary").alias("value")
    )
    return cast_kv(raw)


@query("proj_drop", f"WITH {ep.EP} SELECT uuid, CurrentTime, key, event_type, Result FROM ep")
def proj_drop(spark, sf_dir):
    return ep.endpoints(spark, sf_dir).drop(*column_plan(ENDPOINT).dropped)


@query("proj_rename", f"WITH {ep.EP} SELECT uuid, CurrentTime, key, event_type, Result AS label FROM ep")
def proj_rename(spark, sf_dir):
    return to_feature_table(ep.endpoints(spark, sf_dir), column_plan(ENDPOINT))


@query("filter_key_route", f"WITH {ep.EP} SELECT key, uuid, sensor0 FROM ep WHERE key = 'SVC'")
def filter_key_route(spark, sf_dir):
    return route(ep.endpoints(spark, sf_dir), "SVC").select("key", "uuid", "sensor0")


_branches = (("LR", "key = 'LR'"), ("HOT", "sensor0 > 100"), ("SVC", "key = 'SVC'"), ("RF", "key = 'RF'"))
_branch_case = "CASE " + " ".join(f"WHEN {p} THEN '{n}'" for n, p in _branches) + " END"


@query(
    "branch_first_match",
    f"WITH {ep.EP}, b AS (SELECT uuid, key, {_branch_case} AS branch FROM ep) SELECT * FROM b WHERE branch IS NOT NULL",
)
def branch_first_match(spark, sf_dir):
    rows = ep.endpoints(spark, sf_dir).select("uuid", "key", "sensor0")
    return branch(rows, [(n, F.expr(p)) for n, p in _branches]).drop("sensor0")


@query(
    "fanout_broadcast",
    f"WITH {ep.EP} "
    + " UNION ALL ".join(f"SELECT '{n}' AS branch, uuid, key FROM ep WHERE {p}" for n, p in _branches),
)
def fanout_broadcast(spark, sf_dir):
    """Overlapping predicates: a record is in every branch that accepts it."""
    rows = ep.endpoints(spark, sf_dir).select("uuid", "key", "sensor0")
    return fanout_rows(rows, {n: F.expr(p) for n, p in _branches}).drop("sensor0")


@query("unmatched_keys", f"WITH {ep.EP} SELECT key, count(*) AS n FROM ep WHERE key NOT IN ({_keys}) GROUP BY key")
def unmatched_keys(spark, sf_dir):
    return unmatched(ep.endpoints(spark, sf_dir), list(MODEL_KEYS))


@query(
    "set_union_all",
    f"WITH {ep.EP} SELECT key, uuid FROM ep WHERE key = 'LR' UNION ALL SELECT key, uuid FROM ep WHERE key = 'GBT' "
    "UNION ALL SELECT key, uuid FROM ep WHERE sensor0 > 50",
)
def set_union_all(spark, sf_dir):
    rows = ep.endpoints(spark, sf_dir)
    parts = [route(rows, "LR"), route(rows, "GBT"), rows.filter("sensor0 > 50")]
    return union_all(*[p.select("key", "uuid") for p in parts])


@query("limit_preview", f"WITH {ep.EP} SELECT uuid, key, sensor0 FROM ep ORDER BY sensor0 DESC, uuid LIMIT 10")
def limit_preview(spark, sf_dir):
    rows = ep.endpoints(spark, sf_dir).select("uuid", "key", "sensor0")
    return preview(rows, 10, [F.desc("sensor0"), F.asc("uuid")], show=False)


# --- record functions ---------------------------------------------------------------------------

_thin = "SELECT key, uuid, CurrentTime AS recordTime, CASE WHEN sensor0 / 25e0 > 2e0 THEN 1 ELSE 0 END AS prediction"


@query("udf_map", f"WITH {ep.EP} {_thin} FROM ep")
def udf_map(spark, sf_dir):
    def to_thin(batches):
        for b in batches:
            hot = (b["sensor0"] / 25.0 > 2.0).astype("int32")
            yield b[["key", "uuid", "recordTime"]].assign(prediction=hot)

    rows = ep.endpoints(spark, sf_dir).select("key", "uuid", F.col("CurrentTime").alias("recordTime"), "sensor0")
    return map_records(rows, to_thin, "key string, uuid string, recordTime string, prediction int")


@query("udf_filter", f"WITH {ep.EP} SELECT key, uuid FROM ep WHERE key IN ({_keys}) AND cat3 = 1")
def udf_filter(spark, sf_dir):
    return filter_records(ep.endpoints(spark, sf_dir), matched(MODEL_KEYS) & (F.col("cat3") == 1)).select("key", "uuid")


@query("udf_serde", f"WITH {ep.EP} SELECT key, uuid, Result, {_flat} FROM ep")
def udf_serde(spark, sf_dir):
    """Bytes to record to bytes to record."""
    raw = ep.messages(spark, sf_dir).select(*[F.col(c).cast("binary").alias(c) for c in ("key", "value")])
    once = parse_json(cast_kv(raw), endpoint_schema())
    again = cast_kv(emit_json(once.select("key", "data.*"), endpoint_schema().names))
    parsed = parse_json(again, endpoint_schema())
    return flatten(parsed, ["data.Categories", "data.Sensors"], ["key", "data.uuid", "data.Result"])

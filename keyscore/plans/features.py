"""Feature engineering over whole tables; vectors come back as columns."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keyscore.functions.scalar import parse_json
from keyscore.operators.features import (
    assemble,
    build_pipeline,
    feature_names,
    feature_table,
    fixed_layout,
    minmax,
    onehot,
    split_hash,
    split_nth,
    split_random,
)
from keyscore.operators.projection import expand, flatten
from keyscore.operators.routing import route, union_all
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.records import ENDPOINT, column_plan, record_schema
from keyscore.sources.config import load_config
from keyscore.plans.scans import config_folder
from keyscore.sources.registry import save_model
from keyscore.storage import fresh_path

PLAN = column_plan(ENDPOINT)


def wide(df, vector="features", digits=None):
    return expand(df.withColumn(vector, vector_to_array(vector)), vector, ep.WIDTH, digits=digits)


# --- configuration-driven ----------------------------------------------------------------------


def _cfg_schema_sql():
    parts = []
    for key, (_, cats, sensors) in ep.STREAMS.items():
        parts.append(
            f"SELECT event_type AS key, uuid, CurrentTime AS currentTime, Result AS result, {' + '.join(cats.values())} AS codes, "
            f"round({' + '.join(sensors.values())}, 6) AS total FROM ep WHERE event_type = '{key}'"
        )
    return " UNION ALL ".join(parts)


@query("cfg_schema", f"WITH {ep.EP} {_cfg_schema_sql()}")
def cfg_schema(spark, sf_dir):
    """Messages of all streams, each read with the schema its configuration gives."""
    rows, parts = ep.stream_messages(spark, sf_dir), []
    for cfg in load_config(spark, config_folder(spark), "streams.yml"):
        plan = column_plan(cfg)
        parsed = parse_json(route(rows, cfg.key), record_schema(cfg))
        flat = flatten(
            parsed, ["data.categories", "data.sensors"], ["key", "data.uuid", "data.currentTime", "data.result"]
        )
        codes, total = " + ".join(plan.categories), " + ".join(plan.sensors)
        parts.append(
            flat.selectExpr("key", "uuid", "currentTime", "result", f"{codes} AS codes", f"round({total}, 6) AS total")
        )
    return union_all(*parts)


def _cfg_columns_sql():
    parts = []
    for key, (_, cats, sensors) in ep.STREAMS.items():
        encoded = ",".join(f"{c}Vec" for c in cats)
        dropped = ",".join([f"{c}Vec" for c in cats] + list(sensors) + list(cats) + ["unscaled"])
        parts.append(
            f"SELECT '{key}' AS key, '{','.join(cats)}' AS categories, '{encoded}' AS encoded, "
            f"'{dropped}' AS dropped, count(*) AS records FROM ep WHERE event_type = '{key}'"
        )
    return " UNION ALL ".join(parts)


@query("cfg_columns", f"WITH {ep.EP} {_cfg_columns_sql()}")
def cfg_columns(spark, sf_dir):
    """Column plan of each stream, with the records that it applies to."""
    rows = ep.stream_messages(spark, sf_dir)
    out = []
    for cfg in load_config(spark, config_folder(spark), "streams.yml"):
        plan = column_plan(cfg)
        text = {"key": [cfg.key], "categories": plan.categories, "encoded": plan.encoded, "dropped": plan.dropped}
        counted = route(rows, cfg.key).agg(F.count("*").alias("records"))
        out.append(counted.select(*[F.lit(",".join(v)).alias(k) for k, v in text.items()], "records"))
    return union_all(*out)


# --- encoding, assembling, scaling ------------------------------------------------------------------

_last = ", ".join(
    f"CASE WHEN {c} = {level} THEN 1e0 ELSE 0e0 END AS {c}_{level}"
    for c, size in zip(ep.CATS, ENDPOINT.sizes)
    for level in range(size - 1)
)
_first = ", ".join(
    f"CASE WHEN {c} = {level} THEN 1e0 ELSE 0e0 END AS {c}_{level - 1}"
    for c, size in zip(ep.CATS, ENDPOINT.sizes)
    for level in range(1, size)
)


def _levels(df):
    cols = [F.col(f"{c}Vec")[i].alias(f"{c}_{i}") for c, size in zip(ep.CATS, ENDPOINT.sizes) for i in range(size - 1)]
    return df.select("uuid", *cols)


@query("feat_onehot_droplast", f"WITH {ep.EP} SELECT uuid, {_last} FROM ep")
def feat_onehot_droplast(spark, sf_dir):
    encoded = onehot(ep.endpoints(spark, sf_dir), ep.CATS, drop="last")
    return _levels(encoded.withColumns({f"{c}Vec": vector_to_array(f"{c}Vec") for c in ep.CATS}))


@query("feat_onehot_dropfirst", f"WITH {ep.EP} SELECT uuid, {_first} FROM ep")
def feat_onehot_dropfirst(spark, sf_dir):
    return _levels(onehot(ep.endpoints(spark, sf_dir), ep.CATS, drop="first", sizes=ENDPOINT.sizes))


@query("feat_assemble", f"WITH {ep.LEARNED} SELECT uuid, {ep.slot_list()} FROM learned")
def feat_assemble(spark, sf_dir):
    rows = assemble(onehot(ep.endpoints(spark, sf_dir), ep.CATS), PLAN.assembled)
    return wide(rows.select("uuid", "unscaled"), "unscaled")


@query("feat_minmax", f"WITH {ep.SCALED} SELECT uuid, {ep.slot_list(digits=6)} FROM scaled")
def feat_minmax(spark, sf_dir):
    rows = minmax(assemble(onehot(ep.endpoints(spark, sf_dir), ep.CATS), PLAN.assembled))
    return wide(rows.select("uuid", "features"), digits=6)


# the three feature stages fitted, saved, reloaded and applied as one unit
@query("feat_staged", f"WITH {ep.SCALED} SELECT uuid, CurrentTime, Result AS label, {ep.slot_list(digits=6)} FROM scaled")
def feat_staged(spark, sf_dir):
    flat = ep.endpoints(spark, sf_dir).drop("key", "event_type")
    path = save_model(build_pipeline(PLAN).fit(flat), fresh_path(spark, "stages"))
    return wide(feature_table(flat, PipelineModel.load(path), PLAN), digits=6)


@query("feat_layout30", f"WITH {ep.SLOTS} SELECT uuid, {ep.slot_list()} FROM slots")
def feat_layout30(spark, sf_dir):
    rows = fixed_layout(ep.endpoints(spark, sf_dir), ENDPOINT).select("uuid", "features")
    return wide(rows)


def _names_sql():
    return " UNION ALL ".join(
        f"SELECT CAST({slot} AS INT) AS slot, '{name}' AS name, '{kind}' AS type, round(sum(f{slot}), 4) AS total, "
        f"count(*) AS records FROM slots"
        for slot, name, kind in ENDPOINT.slots()
    )


@query("feat_names", f"WITH {ep.SLOTS} {_names_sql()}")
def feat_names(spark, sf_dir):
    """Name and type of each slot, with the slot's total over all records."""
    rows = fixed_layout(ep.endpoints(spark, sf_dir), ENDPOINT, vector=False)
    slots = [F.struct(F.lit(i).alias("slot"), F.round(F.sum(F.col("features")[i]), 4).alias("total"), F.count("*").alias("records")) for i in range(ep.WIDTH)]
    totals = rows.agg(F.array(*slots).alias("slots")).select(F.inline("slots"))
    return totals.join(feature_names(spark, ENDPOINT), "slot").select("slot", "name", "type", "total", "records")


# --- splits -------------------------------------------------------------------------------------------


@query("split_random", "SELECT count(*) AS rows, true AS disjoint, true AS near_share FROM events")
def split_random_query(spark, sf_dir):
    """Both parts together hold every record once, and the test part its share of them."""
    rows = ep.endpoints(spark, sf_dir).select("uuid")
    train, test = split_random(rows, (0.8, 0.2), 42)
    htrain, htest = split_hash(rows, "uuid", 20)
    parts = union_all(
        *[df.select("uuid", F.lit(s).alias("split"), F.lit(t).alias("test")) for df, s, t in (
            (train, "random", 0), (test, "random", 1), (htrain, "hash", 0), (htest, "hash", 1))]
    )
    sizes = parts.groupBy("split").agg(
        F.count("*").alias("n"), F.countDistinct("uuid").alias("ids"), F.avg("test").alias("share")
    )
    return sizes.agg(
        F.max("n").alias("rows"),
        F.min(F.col("n") == F.col("ids")).alias("disjoint"),
        F.min(F.col("share").between(0.15, 0.25)).alias("near_share"),
    )


@query(
    "split_every_nth",
    f"WITH {ep.EP}, r AS (SELECT uuid, row_number() OVER (ORDER BY CAST(uuid AS BIGINT)) - 1 AS k FROM ep) "
    "SELECT uuid, k, k % 5 = 0 AS is_test FROM r",
)
def split_every_nth(spark, sf_dir):
    rows = ep.endpoints(spark, sf_dir).select("uuid", F.col("uuid").cast("long").alias("position"))
    return split_nth(rows, ["position"], 5).drop("position")

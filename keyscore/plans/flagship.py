"""End to end without a fit: messages, parsing, features, a fixed model, routing, counting."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyscore.functions.scalar import parse_json
from keyscore.operators.evaluation import group_count
from keyscore.operators.features import fixed_layout
from keyscore.operators.projection import expand, flatten
from keyscore.operators.routing import matched
from keyscore.operators.scoring import score_linear
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.plans.scores import INTERCEPT, SLOT_NAMES, WEIGHTS
from keyscore.records import ENDPOINT, MODEL_KEYS, endpoint_schema


@query(
    "flagship",
    f"WITH {ep.SLOTS}, m AS (SELECT key, {ep.linear_sql(SLOT_NAMES, WEIGHTS, INTERCEPT)} AS margin FROM slots) "
    "SELECT key, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction, count(*) AS count FROM m "
    "WHERE key <> 'NONE' GROUP BY ALL",
)
def flagship(spark, sf_dir):
    """Predictions per model key and class."""
    routed = ep.messages(spark, sf_dir).filter(matched(MODEL_KEYS))
    flat = flatten(parse_json(routed, endpoint_schema()), ["data.Categories", "data.Sensors"], ["key", "data.uuid"])
    slots = fixed_layout(flat, ENDPOINT, vector=False).select("key", F.col("features"))
    scored = score_linear(expand(slots, "features", ep.WIDTH), SLOT_NAMES, WEIGHTS, INTERCEPT, link="margin")
    return group_count(scored, ["key", "prediction"])

"""Choosing a branch for each record by its key, and keyed scoring over many models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscore.functions.scalar import parse_json
from keyscore.operators.features import REASONS, fixed_layout, on_invalid_rows, reject_reason, stage_slots
from keyscore.operators.projection import flatten, to_feature_table
from keyscore.records import ColumnPlan, Layout, StreamConfig, column_plan, endpoint_schema, record_schema
from keyscore.sources.registry import Entry


def route(df: DataFrame, key: str) -> DataFrame:
    """Records whose key selects one model."""
    return df.filter(F.col("key") == key)


def branch(df: DataFrame, predicates: Sequence[tuple[str, Column]], name: str = "branch") -> DataFrame:
    """Label each record with the first predicate that holds; records that match none are dropped."""
    choice = reduce(lambda chain, p: chain.when(p[1], p[0]), predicates[1:], F.when(predicates[0][1], predicates[0][0]))
    return df.withColumn(name, choice).filter(F.col(name).isNotNull())


def fanout(df: DataFrame, branches: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Every branch sees every record and keeps what its own predicate accepts."""
    return {name: df.filter(predicate) for name, predicate in branches.items()}


def fanout_rows(df: DataFrame, branches: Mapping[str, Column], name: str = "branch") -> DataFrame:
    """The same copies as one table with a ``branch`` column, from a single pass over the records."""
    accepted = F.array_compact(F.array(*[F.when(p, F.lit(b)) for b, p in branches.items()]))
    return df.select(F.explode(accepted).alias(name), *df.columns)


def matched(keys: Sequence[str]) -> Column:
    """True for a known key, null for no key: as a filter it keeps known keys and reaches the scan."""
    return F.col("key").isin(*keys)


def unknown(keys: Sequence[str]) -> Column:
    """True for any other key and for none."""
    return ~F.coalesce(matched(keys), F.lit(False))


def unmatched(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Side output: how many records each unknown key (or no key) brought."""
    return df.filter(unknown(keys)).groupBy("key").agg(F.count("*").alias("n"))


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


# --- many models, one schema ------------------------------------------------------------

RICH_FIELDS = ("key", "uuid", "CurrentTime", "label", "rawPrediction", "prediction")


def score_multi_model(
    df: DataFrame,
    features: PipelineModel | Layout,
    models: Mapping[str, object],
    layout: Layout,
    on_invalid: str = "error",
) -> DataFrame:
    """Score ``key, value`` messages of one schema with the model that each key names.

    One pass: unknown keys go before anything is parsed, the features are made once, and each row is
    scored by the model of its key. The input is read once however many models there are, in batch and
    in a stream, with no cached copy.

    ``features`` are fitted stages, or a layout of fixed scales, which takes any record. Models are anything that
    adds ``prediction``: a classifier, a fitted chain of stages, or support vectors read from text. One without raw
    predictions gives null for them. With ``skip``, records that the stages cannot take leave, and are counted by
    reason in the observed metrics ``rejects``.
    """
    parsed = parse_json(df.filter(matched(list(models))).select("key", "value"), endpoint_schema(layout))
    flat = flatten(parsed, ["data.Categories", "data.Sensors"], ["key", "data.uuid", "data.CurrentTime", "data.Result"])
    plan = column_plan(layout)
    if isinstance(features, Layout):
        slots = fixed_layout(take_valid(flat, plan, None, on_invalid), features)
        table = slots.select("key", "uuid", "CurrentTime", F.col("Result").alias("label"), "features")
    else:
        table = to_feature_table(features.transform(take_valid(flat, plan, features, on_invalid)), plan)
    scored = _by_key(table, models)
    return scored.select("key", "uuid", "CurrentTime", "label", "rawPrediction", "prediction")


def _by_key(table: DataFrame, models: Mapping[str, object], inputs: Mapping[str, str] | None = None) -> DataFrame:
    """``table`` with ``rawPrediction`` and ``prediction`` of the model that each row's key names.

    A row is scored by its own model only. A model's raw margins stand in the branch of its key and nowhere else, so
    Spark works them out for the rows of that branch; the prediction is the larger of the chosen margins. A model that
    decides otherwise (a threshold, weights of classes) or has no raw margins brings its own prediction; if it passes over
    null features (``skips_null``), it gets those of its key's rows only. ``inputs`` names
    the features of each key, where they are not ``features`` for all.
    """
    kept, raw, prediction = table.columns, F.lit(None).cast(VectorUDT()), F.lit(None).cast("double")
    for i, (key, model) in enumerate(models.items()):
        here = F.col("key") == key
        if _plain_margins(model):
            copy = model.copy().setRawPredictionCol(f"_raw{i}").setPredictionCol("")
            copy = copy.setFeaturesCol(inputs[key]) if inputs else copy
            # an empty name switches an output off; SVMs have no probability
            copy = copy.setProbabilityCol("") if hasattr(copy, "setProbabilityCol") else copy
            table = copy.transform(table)
            raw = F.when(here, F.col(f"_raw{i}")).otherwise(raw)
        else:
            given = F.col(inputs[key] if inputs else "features")
            own = table.withColumn("_given", given).withColumn("features", F.when(here, given) if getattr(model, "skips_null", False) else given)
            scored = model.transform(own)
            if "rawPrediction" in scored.columns:
                raw = F.when(here, F.col(f"_raw{i}")).otherwise(raw)
            margins = F.col("rawPrediction") if "rawPrediction" in scored.columns else F.lit(None).cast(VectorUDT())
            if not inputs:
                scored = scored.withColumn("features", F.col("_given"))
            table = scored.select(*table.columns, margins.alias(f"_raw{i}"), F.col("prediction").cast("double").alias(f"_prediction{i}"))
            prediction = F.when(here, F.col(f"_prediction{i}")).otherwise(prediction)
    chosen = table.select(*kept, raw.alias("rawPrediction"), prediction.alias("_own"))
    margins = vector_to_array("rawPrediction")
    larger = F.when(F.col("rawPrediction").isNotNull(), (margins[1] > margins[0]).cast("double"))
    return chosen.withColumn("prediction", F.coalesce("_own", larger)).drop("_own")


def _plain_margins(model) -> bool:
    """Whether a fitted classifier predicts the class of the larger margin."""
    if not hasattr(model, "setRawPredictionCol"):
        return False
    if model.hasParam("thresholds") and model.isDefined("thresholds"):
        return False
    plain = {"LinearSVCModel": 0.0}.get(type(model).__name__, 0.5)
    return not model.hasParam("threshold") or model.getOrDefault("threshold") == plain


def take_valid(flat: DataFrame, plan: ColumnPlan, features: PipelineModel | None, on_invalid: str) -> DataFrame:
    """The records that the features can be made of.

    With ``skip`` the others leave, counted by reason; without fitted stages no category code is unseen.
    """
    if on_invalid != "skip":
        return on_invalid_rows(flat, plan, features, on_invalid)
    reason = reject_reason(plan, features)
    named = flat.withColumn("_reason", reason)
    counts = [F.count_if(F.col("_reason") == r).alias(r.replace(" ", "_")) for r in REASONS]
    return named.observe("rejects", *counts).filter(F.col("_reason").isNull()).drop("_reason")


def score_or_reject(df: DataFrame, features: PipelineModel | Layout, models: Mapping[str, object], layout: Layout) -> DataFrame:
    """Every ``key, value`` message once, as ``output, key, value, reason``: one parse, two kinds of row.

    A scored record is a ``result`` whose value is the JSON of its prediction. Anything else is a ``rejected`` one with
    its text as it came and the reason: ``unknown key``, ``malformed``, or what the feature stages cannot take. Rejected
    records go through the same stages with neutral values, so nothing is filtered away and read again.
    """
    known = F.coalesce(matched(list(models)), F.lit(False))
    schema, plan = endpoint_schema(layout), column_plan(layout)
    parsed = df.select("key", "value", F.from_json(F.when(known, F.col("value")), schema).alias("data"))
    flat = parsed.select("key", "value", "data", "data.uuid", "data.CurrentTime", "data.Result", "data.Categories.*", "data.Sensors.*")
    nothing = reduce(lambda a, b: a & b, [F.col(f"data.{name}").isNull() for name in schema.names])
    stages = None if isinstance(features, Layout) else features
    reason = F.when(~known, "unknown key").when(nothing, "malformed").otherwise(reject_reason(plan, stages))
    judged = flat.withColumn("reason", reason)
    fine = F.col("reason").isNull()
    neutral = {c: F.when(fine, F.col(c)).otherwise(F.lit(0)) for c in plan.categories}
    neutral |= {c: F.when(fine, F.col(c)).otherwise(F.lit(0.0)) for c in plan.sensors}
    clean = judged.withColumns(neutral)
    made = fixed_layout(clean, features) if isinstance(features, Layout) else features.transform(clean)
    scored = _by_key(made.select("key", "value", "reason", "uuid", "CurrentTime", F.col("Result").alias("label"), "features"), models)
    result = F.to_json(F.struct("key", "uuid", "CurrentTime", "label", "prediction"))
    return scored.select(
        F.when(fine, "result").otherwise("rejected").alias("output"), "key", F.when(fine, result).otherwise(F.col("value")).alias("value"), "reason"
    )


def thin_results(scored: DataFrame) -> DataFrame:
    """key, uuid, recordTime and the prediction as a whole number."""
    return scored.select("key", "uuid", F.col("CurrentTime").alias("recordTime"), F.col("prediction").cast("int").alias("prediction"))


# --- many schemas, many feature stages, many models ---------------------------------------


def score_stream_branch(df: DataFrame, entry: Entry, on_invalid: str = "error") -> DataFrame:
    """One key's records: filter before parsing, its own schema, feature stages and model."""
    cfg = entry.config
    plan: ColumnPlan = column_plan(cfg)
    parsed = parse_json(route(df, cfg.key).select("key", "value"), record_schema(cfg))
    flat = flatten(
        parsed, ["data.categories", "data.sensors"], ["key", "data.uuid", "data.currentTime", "data.result"]
    )
    ready = take_valid(flat, plan, entry.features, on_invalid)
    table = to_feature_table(entry.features.transform(ready), plan)
    scored = entry.model.transform(table)
    return scored.select("key", "uuid", "currentTime", "label", "rawPrediction", "prediction")


def score_multi_schema(df: DataFrame, registry: Mapping[str, Entry], on_invalid: str = "error") -> DataFrame:
    """Score ``key, value`` messages whose key selects schema, feature stages and model.

    Each branch filters on the key first, so a record is parsed and scored once, by its own branch.
    A table partitioned by key is read once in total; ``stage_by_key`` brings any other batch input
    into that form, and a stream job shares its persisted micro-batch among the branches.
    """
    return union_all(*[score_stream_branch(df, entry, on_invalid) for entry in registry.values()])


def score_variant(df: DataFrame, registry: Mapping[str, Entry], on_invalid: str = "error") -> DataFrame:
    """The same scores in one branch: the text becomes a VARIANT once, and each key takes the fields of its own schema.

    The fitted stages of a key are expressions over its fields and stand, like its model, in the key's branch of a CASE;
    one plan reads the input once, with no union and no kept copy, so a stream uses any sink. ``error`` fails on a record
    that its stages cannot take; ``skip`` leaves it out and counts it by reason in the observed metrics ``rejects``.
    """
    if on_invalid not in ("error", "skip"):
        raise ValueError("on_invalid must be 'error' or 'skip'")
    rows = df.filter(matched(list(registry))).select("key", F.try_parse_json("value").alias("_v"))
    field = lambda path, kind: F.try_variant_get("_v", f"$.{path}", kind)
    reason, vectors, names = F.lit(None).cast("string"), {}, {}
    for i, (key, entry) in enumerate(registry.items()):
        plan, here = column_plan(entry.config), F.col("key") == key
        at = {c: field(f'categories["{c}"]', "int") for c in plan.categories} | {c: field(f'sensors["{c}"]', "double") for c in plan.sensors}
        reason = F.when(here, reject_reason(plan, entry.features, at)).otherwise(reason)
        slots = stage_slots(entry.features, plan, at)
        names[key] = f"_features{i}"
        vectors[names[key]] = array_to_vector(F.when(here, F.array(*slots)).otherwise(F.array(*[F.lit(0.0)] * len(slots))))
    judged = rows.withColumn("_reason", F.when(F.col("_v").isNull(), "malformed").otherwise(reason))
    if on_invalid == "skip":
        counts = [F.count_if(F.col("_reason") == r).alias(r.replace(" ", "_")) for r in ("malformed", *REASONS)]
        judged = judged.observe("rejects", *counts).filter(F.col("_reason").isNull())
    else:
        judged = judged.filter(F.when(F.col("_reason").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("a record cannot be scored: "), "_reason")).cast("boolean")))
    table = judged.select(
        "key", field("uuid", "string").alias("uuid"), field("currentTime", "string").alias("currentTime"), field("result", "int").alias("label"), *(v.alias(n) for n, v in vectors.items())
    )
    scored = _by_key(table, {key: entry.model for key, entry in registry.items()}, names)
    return scored.select("key", "uuid", "currentTime", "label", "rawPrediction", "prediction")


def rejects(df: DataFrame, source: Layout | StreamConfig, features: PipelineModel) -> DataFrame:
    """Side output: ``key, value`` messages that the feature stages cannot take, and why.

    ``malformed`` text gives a record of nulls; otherwise the reasons are those of ``reject_reason``.
    """
    schema = endpoint_schema(source) if isinstance(source, Layout) else record_schema(source)
    parsed = df.select("key", "value", F.from_json("value", schema).alias("data"))
    categories, sensors = schema.names[-2:]
    flat = parsed.select("key", "value", "data", f"data.{categories}.*", f"data.{sensors}.*")
    nothing = reduce(lambda a, b: a & b, [F.col(f"data.{name}").isNull() for name in schema.names])
    reason = F.when(nothing, "malformed").otherwise(reject_reason(column_plan(source), features))
    return flat.select("key", "value", reason.alias("reason")).filter(F.col("reason").isNotNull())


def stage_by_key(df: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Write the messages of known keys split by key, so that each branch reads its own part only."""
    df.filter(matched(keys)).select("key", "value").write.mode("overwrite").partitionBy("key").parquet(path)
    spark = df.sparkSession
    return spark.read.schema("value string, key string").parquet(path)

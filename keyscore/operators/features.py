"""Feature tables: the two one-hot conventions, assembling, scaling and splitting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, MinMaxScalerModel, OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyscore.functions.scalar import feature_array, scale
from keyscore.operators.projection import to_feature_table
from keyscore.records import ColumnPlan, Layout, StreamConfig, column_plan
from keyscore.storage import fresh_path


def onehot(
    df: DataFrame, cols: Sequence[str], drop: str = "last", sizes: Sequence[int] | None = None, suffix: str = "Vec"
) -> DataFrame:
    """One-hot encode integer columns.

    ``drop="last"`` learns the number of levels; the last level is all zeros and an unseen code is
    an error. ``drop="first"`` takes ``sizes``; code 0 and unseen codes are all zeros.
    """
    if drop == "last":
        encoder = OneHotEncoder(inputCols=list(cols), outputCols=[c + suffix for c in cols])
        return encoder.fit(df).transform(df)
    if drop != "first" or sizes is None:
        raise ValueError("drop must be 'last', or 'first' with sizes")
    return df.withColumns(
        {c + suffix: feature_array(_indicators(F.col(c), size)) for c, size in zip(cols, sizes)}
    )


def _indicators(code: Column, size: int) -> list[Column]:
    return [F.when(code == level, 1.0).otherwise(0.0) for level in range(1, size)]


def assemble(df: DataFrame, cols: Sequence[str], out: str = "unscaled") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def minmax(df: DataFrame, inp: str = "unscaled", out: str = "features") -> DataFrame:
    """Scale each slot to [0, 1] by its own range; a constant slot becomes 0.5."""
    return MinMaxScaler(inputCol=inp, outputCol=out).fit(df).transform(df)


def build_pipeline(plan: ColumnPlan, on_invalid: str = "error") -> Pipeline:
    """Encode, assemble and scale, to be fitted, saved and applied as one unit.

    ``error`` fails on a null or an unseen category; ``keep`` gives an unseen category a slot of
    its own and a null sensor NaN.
    """
    if on_invalid not in ("error", "keep"):
        raise ValueError("on_invalid must be 'error' or 'keep'")
    return Pipeline(
        stages=[
            OneHotEncoder(inputCols=plan.categories, outputCols=plan.encoded, handleInvalid=on_invalid),
            VectorAssembler(inputCols=plan.assembled, outputCol="unscaled", handleInvalid=on_invalid),
            MinMaxScaler(inputCol="unscaled", outputCol="features"),
        ]
    )


KEYED_MAPS = "categories map<string,int>, sensors map<string,double>"


def stage_statistics(messages: DataFrame) -> DataFrame:
    """What the stages of all streams need, from one pass over ``key, value`` messages of any schema.

    A row for each (key, category, level) with its count, and one for each (key, sensor) with count, minimum and
    maximum; a row without a name counts the key's records. Every record is read into two maps by one schema, so the
    streams' own schemas are not needed, and rows are summed where they are read.
    """
    data = F.from_json("value", KEYED_MAPS)
    entry = lambda kind, name, level, v: F.struct(F.lit(kind).alias("kind"), name.alias("name"), level.alias("level"), v.alias("v"))
    none = F.lit(None)
    whole = F.array(entry("record", none.cast("string"), none.cast("int"), none.cast("double")))
    categories = F.transform(F.map_entries("data.categories"), lambda e: entry("category", e["key"], e["value"], none.cast("double")))
    sensors = F.transform(F.map_entries("data.sensors"), lambda e: entry("sensor", e["key"], none.cast("int"), e["value"]))
    empty = F.array().cast("array<struct<kind:string,name:string,level:int,v:double>>")
    parts = F.concat(whole, F.coalesce(categories, empty), F.coalesce(sensors, empty))
    rows = messages.select("key", data.alias("data")).select("key", F.inline(parts))
    return rows.groupBy("key", "kind", "name", "level").agg(F.count("*").alias("n"), F.count("v").alias("values"), F.min("v").alias("low"), F.max("v").alias("high"))


def fit_stages(messages: DataFrame, registry: Sequence[StreamConfig]) -> dict[str, PipelineModel]:
    """The fitted feature stages of all configured streams, from one scan of their messages.

    Encoder and scaler know a stream by its levels and ranges only. So each stream's stages are fitted on a few rows that
    have every level and both ends of every range, which gives the same stages as its records do. A stream without
    records, or with a null or missing value, is an error, as it is for the stages. What reaches the driver is a row for
    each level and sensor, as many as the stages have parameters.
    """
    plans = {cfg.key: column_plan(cfg) for cfg in registry}
    names = [n for plan in plans.values() for n in (*plan.categories, *plan.sensors)]
    wanted = F.col("key").isin(*plans) & (F.col("name").isNull() | F.col("name").isin(*names))
    found: dict[str, dict] = {key: {"n": 0, "levels": {}, "range": {}, "seen": {}} for key in plans}
    for r in stage_statistics(messages).where(wanted).collect():
        stream = found[r.key]
        if r.kind == "record":
            stream["n"] = r.n
        elif r.kind == "category" and r.level is not None:
            stream["levels"].setdefault(r.name, []).append(r.level)
            stream["seen"][r.name] = stream["seen"].get(r.name, 0) + r.n
        elif r.kind == "sensor":
            stream["range"][r.name], stream["seen"][r.name] = (r.low, r.high), r["values"]
    out = {}
    for cfg in registry:
        plan, stream = plans[cfg.key], found[cfg.key]
        short = [n for n in (*plan.categories, *plan.sensors) if not stream["n"] or stream["seen"].get(n, 0) != stream["n"]]
        if short:
            raise ValueError(f"stream {cfg.key}: {stream['n']} records, not all of them with {', '.join(short)}")
        levels = [sorted(stream["levels"][c]) for c in plan.categories]
        ranges = [stream["range"][c] for c in plan.sensors]
        rows = [
            (*(x[i % len(x)] for x in levels), *(float(low if i == 0 else high) for low, high in ranges))
            for i in range(max(2, *(len(x) for x in levels), 2))
        ]
        schema = ", ".join([*(f"`{c}` int" for c in plan.categories), *(f"`{c}` double" for c in plan.sensors)])
        out[cfg.key] = build_pipeline(plan).fit(messages.sparkSession.createDataFrame(rows, schema))
    return out


def stage_slots(features: PipelineModel, plan: ColumnPlan, values: dict[str, Column]) -> list[Column]:
    """The slots that fitted stages make, as expressions over the given values: indicators without the last level, then
    sensors, scaled as the fitted scaler does."""
    encoder = next(s for s in features.stages if isinstance(s, OneHotEncoderModel))
    scaler = next(s for s in features.stages if isinstance(s, MinMaxScalerModel))
    sizes = dict(zip(encoder.getInputCols(), encoder.categorySizes))
    raw = [F.when(values[c] == level, 1.0).otherwise(0.0) for c in plan.categories for level in range(sizes[c] - 1)]
    raw += [values[c] for c in plan.sensors]
    out = []
    for x, low, high in zip(raw, scaler.originalMin.toArray(), scaler.originalMax.toArray(), strict=True):
        constant = F.lit(0.5 * (scaler.getMin() + scaler.getMax()))
        step = (scaler.getMax() - scaler.getMin()) / (high - low) if high != low else 0.0
        out.append((x - F.lit(float(low))) * F.lit(float(step)) + F.lit(scaler.getMin()) if step else constant)
    return out


def feature_table(df: DataFrame, model: PipelineModel, plan: ColumnPlan) -> DataFrame:
    """Apply fitted stages and keep identity columns, label and features."""
    return to_feature_table(model.transform(df), plan)


def fixed_layout(df: DataFrame, layout: Layout, out: str = "features", vector: bool = True) -> DataFrame:
    """Sensors over their fixed divisors, then the indicators of every category (code 0 all zeros)."""
    exprs = [scale(F.col(s), d) for s, d in zip(layout.sensors, layout.divisors)]
    for name, size in zip(layout.categories, layout.sizes):
        exprs += _indicators(F.col(name), size)
    slots = feature_array(exprs)
    return df.withColumn(out, array_to_vector(slots) if vector else slots)


def feature_names(spark, layout: Layout) -> DataFrame:
    """slot, name and type (q numeric, i indicator) of a layout."""
    return spark.createDataFrame(layout.slots(), "slot int, name string, type string")


# --- records that the feature stages cannot take -------------------------------------------


#: Why a record cannot be scored, as ``reject_reason`` says it.
REASONS = ("null value", "not a number", "unseen category")


def reject_reason(plan: ColumnPlan, features: PipelineModel | None, at: dict[str, Column] | None = None) -> Column:
    """Why the fitted stages cannot take a record, or null: a null or NaN value, or a category code never seen in the fit.

    Malformed text parses to a record of nulls. Without stages (fixed scales) no code is unseen. ``at`` are the values
    where they are not columns of their names.
    """
    at = at or {c: F.col(c) for c in plan.categories + plan.sensors}
    encoders = [s for s in features.stages if isinstance(s, OneHotEncoderModel)] if features else []
    sizes = dict(zip(encoders[0].getInputCols(), encoders[0].categorySizes)) if encoders else {}
    values = [at[c] for c in plan.categories + plan.sensors]
    some_null = reduce(lambda a, b: a | b, [v.isNull() for v in values])
    some_nan = reduce(lambda a, b: a | b, [F.isnan(at[c].cast("double")) for c in plan.sensors], F.lit(False))
    unseen = reduce(lambda a, b: a | b, [(at[c] < 0) | (at[c] >= sizes[c]) for c in plan.categories if c in sizes], F.lit(False))
    return F.when(some_null, "null value").when(some_nan, "not a number").when(unseen, "unseen category")


def invalid_record(plan: ColumnPlan, features: PipelineModel) -> Column:
    """True where the fitted stages cannot take a record."""
    return reject_reason(plan, features).isNotNull()


def on_invalid_rows(df: DataFrame, plan: ColumnPlan, features: PipelineModel, on_invalid: str) -> DataFrame:
    """``skip`` leaves bad records out; ``error`` and ``keep`` hand them to the stages, which were
    fitted to fail on them or to keep them."""
    if on_invalid in ("error", "keep"):
        return df
    if on_invalid == "skip":
        return df.filter(~invalid_record(plan, features))
    raise ValueError("on_invalid must be 'error', 'skip' or 'keep'")


# --- splits -----------------------------------------------------------------------------------


def split_random(df: DataFrame, fractions: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Parts of about the given shares, drawn from ``seed`` and the row's content: whatever the number of cores or
    partitions, a row (and its equals) is in the same part. No shuffle, no sort."""
    steps = 1 << 30
    draw = F.pmod(F.xxhash64(F.lit(seed), F.struct(*(F.col(f"`{c}`") for c in df.columns))), F.lit(steps))
    total, low, parts = sum(fractions), 0, []
    for i in range(len(fractions)):
        high = steps if i == len(fractions) - 1 else int(steps * sum(fractions[: i + 1]) / total)
        parts.append(df.filter((draw >= low) & (draw < high)))
        low = high
    return parts


def split_hash(df: DataFrame, key: str, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """Train and test by a hash of the record's id: the same rows whatever the partitioning, no shuffle."""
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(100))
    return df.filter(bucket >= test_percent), df.filter(bucket < test_percent)


def split_nth(df: DataFrame, order_by: Sequence[str], n: int = 5, partitions: int | None = None) -> DataFrame:
    """Number the rows 0, 1, ... in order and mark every nth one as test: columns ``k, is_test``.

    The rows are range-partitioned and sorted once, written to the shared folder with their
    position inside their partition, and numbered by adding the row counts of the partitions
    before. Only those counts, one per partition, meet in a single task. Rows with equal order
    columns are spread by a hash of the whole row, and rows that are equal in all columns by where they stand in the
    input: which of them gets which number makes no difference.
    """
    spark = df.sparkSession
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [F.col(c) for c in order_by]
    tie = F.xxhash64(*df.columns)
    path = fresh_path(spark, "split")
    (
        df.withColumns({"_tie": tie, "_at": F.monotonically_increasing_id()})
        .repartitionByRange(parts, *keys, F.col("_tie"), F.col("_at"))
        .sortWithinPartitions(*keys, "_tie")
        .withColumn("_part", F.spark_partition_id())
        # the low 33 bits count the rows of the partition
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        .drop("_tie", "_at")
        .write.parquet(path)
    )
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # one row per partition, so its size is bounded by ``parts``
    numbered = ranged.join(F.broadcast(starts), "_part").withColumn("k", F.col("_start") + F.col("_pos"))
    return numbered.withColumn("is_test", F.col("k") % n == 0).drop("_part", "_pos", "_start")

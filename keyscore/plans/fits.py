"""Fits on whole tables. SQL has no fits: it counts the held-out records and the accuracy of the rule behind their labels,
and each query says whether its fit comes near to that."""

from __future__ import annotations

from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keyscore.operators.evaluation import auc_by_round
from keyscore.operators.routing import union_all
from keyscore.operators.scoring import nearest_center
from keyscore.operators.training import (
    FITS,
    _side_by_side,
    evaluate_stream,
    fit_boosted_forest,
    fit_gbt,
    fit_kmeans,
    fit_linear_svc,
    fit_logreg,
    fit_per_stream,
    fit_random_forest,
    fit_rbf_svm,
    fit_softmax_lr,
    reload_parity,
)
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.sources.sinks import REPORT_SCHEMA
from keyscore.storage import fresh_path, shared


# A fifth of the records is held out, the same ones in Spark and in SQL. Labels follow the rule sensor0 > 50 but for
# the one in 17 that is flipped, so no model can be expected above the rule's accuracy; a fit may stay DISTANCE below.
DISTANCE = 0.08
TEST = "CAST(uuid AS BIGINT) % 5 = 0"
RULE = "CAST(avg(CASE WHEN (sensor0 > 50) = (Result = 1) THEN 1e0 ELSE 0e0 END) AS DOUBLE)"


def parts(spark, sf_dir):
    """Training and held-out records with fixed-scale features; sensor0 says what the rule says."""
    rows = ep.vectors(spark, sf_dir).withColumn("rule", (vector_to_array("features")[0] * ep.ENDPOINT.divisors[0] > 50).cast("int"))
    return rows.filter(f"NOT ({TEST})"), rows.filter(TEST)


def _quality(scored, name):
    """Held-out rows, positives and the rule's accuracy, and whether the model comes near to it."""
    right = lambda c: F.avg((F.col(c).cast("int") == F.col("label")).cast("double"))
    both = scored.agg(F.count("*").alias("rows"), F.sum("label").alias("positives"), right("rule").alias("rule"), right("prediction").alias("model"))
    return both.select(
        F.lit(name).alias("model"),
        "rows",
        "positives",
        F.round("rule", 9).alias("rule_accuracy"),
        (F.col("model") >= F.col("rule") - DISTANCE).alias("met"),
    )


def _quality_sql(name):
    return (
        f"WITH {ep.EP} SELECT '{name}' AS model, count(*) AS rows, sum(Result) AS positives, round({RULE}, 9) AS rule_accuracy, "
        f"true AS met FROM ep WHERE {TEST}"
    )


def _held_out(key, name, fit):
    """Fit on four fifths of the records, judge on the rest."""

    @query(key, _quality_sql(name))
    def run(spark, sf_dir):
        train, test = parts(spark, sf_dir)
        with shared(train.select("features", "label")) as rows:
            model = fit(rows)
        return _quality(model.transform(test), name)


_held_out("fit_logreg", "lr", fit_logreg)
_held_out("fit_linear_svc", "svc", fit_linear_svc)
_held_out("fit_random_forest", "rf", fit_random_forest)
_held_out("fit_gbt", "gbt", fit_gbt)
_held_out("fit_rbf_svm", "rbf svm", lambda rows: fit_rbf_svm(rows, ep.WIDTH))


def _rounds(df, model, part):
    """Rows and positives of a part beside each round, and whether the round's scores rank them well."""
    counts = df.agg(F.count("*").alias("rows"), F.sum("label").alias("positives"))
    aucs = auc_by_round(df, model).select(F.lit(part).alias("part"), "round", (F.col("auc") >= 0.85).alias("met"))
    return aucs.join(F.broadcast(counts))  # one row of counts


ROUNDS_SQL = (
    f"WITH {ep.EP}, r AS (SELECT CAST(unnest(range(5)) AS INT) AS round), "
    f"p AS (SELECT CASE WHEN {TEST} THEN 'test' ELSE 'train' END AS part, count(*) AS rows, sum(Result) AS positives FROM ep GROUP BY 1) "
    "SELECT part, round, true AS met, rows, positives FROM p, r"
)


@query("fit_boosted_forest", f"{ROUNDS_SQL} WHERE part = 'test'")
def fit_boosted_forest_query(spark, sf_dir):
    """Scores of the held-out records after each round."""
    train, test = parts(spark, sf_dir)
    # the fit reads its rows once and goes on from tables of its own
    model = fit_boosted_forest(train.select("features", "label"))
    return _rounds(test, model, "test")


@query("fit_kmeans", "SELECT count(*) AS records, count(*) AS nearest, CAST(2 AS INT) AS clusters FROM events")
def fit_kmeans_query(spark, sf_dir):
    """Every record is in the cluster whose fitted centre is nearest."""
    table = ep.vectors(spark, sf_dir).select("features")
    with shared(table) as rows:
        model = fit_kmeans(rows)
    clusters = model.clusterCenters()
    both = nearest_center(model.copy({model.predictionCol: "cluster"}).transform(table), clusters)
    return both.agg(
        F.count("*").alias("records"), F.count_if(F.col("cluster") == F.col("prediction")).alias("nearest")
    ).withColumn("clusters", F.lit(len(clusters)))


_moments = " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS slot, round(avg(Result * f{i}), 6) AS moment, true AS met FROM slots" for i in range(ep.WIDTH)
)


@query(
    "fit_softmax_lr",
    f"WITH {ep.SLOTS} {_moments} UNION ALL SELECT CAST(-1 AS INT), round(avg(Result), 6), true FROM slots",
)
def fit_softmax_lr_query(spark, sf_dir):
    """At the optimum the gradient is zero: the mean of p * feature is the mean of label * feature,
    for every slot, and the mean of p that of the label (slot -1). ``met`` says that the fit's
    moment is within 1e-6 of the label's."""
    table = ep.vectors(spark, sf_dir)
    with shared(table) as rows:
        model = fit_softmax_lr(rows, max_iter=1000, tol=1e-10)
    p = vector_to_array("probability")[1]
    x = model.transform(table).select("label", p.alias("p"), vector_to_array("features").alias("x"))
    means = []
    for slot in range(-1, ep.WIDTH):
        feature = F.lit(1.0) if slot < 0 else F.col("x")[slot]
        moment, fitted = F.avg(F.col("label") * feature), F.avg(F.col("p") * feature)
        means.append(
            F.struct(
                F.lit(slot).alias("slot"),
                F.round(moment, 6).alias("moment"),
                (F.abs(fitted - moment) < 1e-6).alias("met"),
            )
        )
    return x.agg(F.array(*means).alias("m")).select(F.inline("m"))


@query(
    "fit_per_stream",
    f"""WITH {ep.EP}, k AS (SELECT unnest(['gbt', 'kmeans', 'lr', 'rf', 'svc']) AS model)
      SELECT event_type AS key, model, CAST(count(*) AS DOUBLE) AS scored, true AS met FROM ep, k GROUP BY event_type, model""",
)
def fit_per_stream_query(spark, sf_dir):
    """Feature stages and five kinds of model for each stream, saved, evaluated on its records and reported. ``met``: a
    classifier is well above chance, so a constant one would fail; clusters lie apart."""
    base, configs = fresh_path(spark, "models"), ep.stream_configs()
    rows = {c.key: ep.stream_records(spark, sf_dir, c.key) for c in configs}
    kinds = ("lr", "svc", "rf", "gbt", "kmeans")
    fitted = fit_per_stream(rows, configs, base, kinds=kinds, messages=ep.stream_messages(spark, sf_dir))
    report = fresh_path(spark, "report")
    for cfg in configs:
        evaluate_stream(fitted[cfg.key], rows[cfg.key], cfg, report)
    written = spark.read.schema(REPORT_SCHEMA).json(report)
    value = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("value")))
    clusters = F.sum(F.when(F.col("metric").startswith("cluster "), F.col("value")))
    kinds = written.groupBy(F.col("stream").alias("key"), "model").agg(
        F.coalesce(value("rows"), clusters).alias("scored"),
        (F.coalesce(value("auc"), value("silhouette") + 0.5) >= 0.6).alias("met"),
    )
    return kinds


_kinds = ("lr", "svc", "rf", "gbt", "kmeans", "softmax", "forest", "rbf")


@query(
    "reload_parity",
    " UNION ALL ".join(f"SELECT '{k}' AS model, count(*) AS rows, CAST(0 AS BIGINT) AS differ FROM events" for k in _kinds),
)
def reload_parity_query(spark, sf_dir):
    """Every kind of model saved, reloaded and compared on every record."""
    table = ep.vectors(spark, sf_dir)
    base, parts = fresh_path(spark, "models"), []
    with shared(table) as rows:
        # a step of a fit is a small job that leaves most cores idle, so the fits run beside each other, the longest first
        fits = {kind: partial(fit_rbf_svm, rows, ep.WIDTH) if kind == "rbf" else partial(FITS[kind], rows) for kind in reversed(_kinds)}
        models = dict(zip(fits, _side_by_side(spark, list(fits.values()), parallelism=4)))
        for kind in _kinds:
            model = models[kind]
            same = reload_parity(model, kind, f"{base}/{kind}", table).groupBy(F.lit(kind).alias("model"))
            parts.append(same.agg(F.count("*").alias("rows"), F.count_if(~F.col("same")).alias("differ")))
    return union_all(*parts)

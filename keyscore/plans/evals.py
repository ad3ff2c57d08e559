"""Aggregates and evaluation over whole tables, on the predictions of a fixed model."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keyscore.operators.epochs import ScoreLog, fit_softmax_epochs
from keyscore.operators.evaluation import (
    accuracy,
    auc_hard,
    auc_score,
    centers,
    confusion,
    describe_long,
    group_count,
    loss_history,
    prf,
    silhouette,
)
from keyscore.operators.routing import union_all
from keyscore.operators.scoring import nearest_center
from keyscore.operators.training import fit_gbt, fit_kmeans, fit_logreg
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.plans.scores import CENTERS, NEAREST
from keyscore.storage import shared


@query("agg_group_count", f"WITH {ep.EP} SELECT Result, count(*) AS count FROM ep GROUP BY Result")
def agg_group_count(spark, sf_dir):
    return group_count(ep.endpoints(spark, sf_dir), ["Result"])


DESCRIBED = ("Result",) + ep.CATS + ep.SENSORS
_describe = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM ep"
    for c in DESCRIBED
)


@query("agg_describe", f"WITH {ep.EP} {_describe}")
def agg_describe(spark, sf_dir):
    stats = describe_long(ep.endpoints(spark, sf_dir), DESCRIBED)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "eval_auc_hard",
    f"WITH {ep.PR} SELECT round((avg(CASE WHEN label = 1 THEN prediction END) "
    "+ avg(CASE WHEN label = 0 THEN 1 - prediction END)) / 2, 9) AS auc FROM pr",
)
def eval_auc_hard(spark, sf_dir):
    return auc_hard(ep.predictions(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


@query(
    "eval_auc_score",
    f"""WITH {ep.PR}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS k FROM pr)
      SELECT round((sum(CASE WHEN label = 1 THEN k END) - sum(label) * (sum(label) + 1) / 2e0)
        / (CAST(sum(label) AS DOUBLE) * sum(1 - label)), 9) AS auc FROM r""",
)
def eval_auc_score(spark, sf_dir):
    return auc_score(ep.predictions(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


@query(
    "eval_accuracy",
    f"WITH {ep.PR} SELECT round(avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 9) AS accuracy FROM pr",
)
def eval_accuracy(spark, sf_dir):
    return accuracy(ep.predictions(spark, sf_dir)).select(F.round("accuracy", 9).alias("accuracy"))


@query("eval_confusion", f"WITH {ep.PR} SELECT label, prediction, count(*) AS count FROM pr GROUP BY label, prediction")
def eval_confusion(spark, sf_dir):
    return confusion(ep.predictions(spark, sf_dir))


@query(
    "eval_prf",
    f"""WITH {ep.PR}, c AS (SELECT CAST(count(*) FILTER (WHERE prediction = 1 AND label = 1) AS DOUBLE) AS tp,
        CAST(count(*) FILTER (WHERE prediction = 1) AS DOUBLE) AS said,
        CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS real FROM pr),
      q AS (SELECT tp / said AS p, tp / real AS r FROM c)
      SELECT round(p, 9) AS precision, round(r, 9) AS recall, round(2 * p * r / (p + r), 9) AS f1 FROM q""",
)
def eval_prf(spark, sf_dir):
    stats = prf(ep.predictions(spark, sf_dir))
    return stats.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


SILHOUETTE = f"""WITH {NEAREST},
  e AS (SELECT vec_id, prediction AS cl, i, CAST(v AS DOUBLE) AS v FROM ev JOIN near USING (vec_id)),
  m AS (SELECT cl, i, sum(v) AS y FROM e GROUP BY 1, 2),
  n AS (SELECT prediction AS cl, count(*) AS n FROM near GROUP BY 1),
  w AS (SELECT vec_id, cl, sum(v * v) AS x2 FROM e GROUP BY 1, 2),
  ps AS (SELECT cl, sum(x2) AS psi FROM w GROUP BY 1),
  dd AS (SELECT e.vec_id, e.cl AS own, m.cl AS oth, sum(e.v * m.y) AS xy FROM e JOIN m USING (i) GROUP BY 1, 2, 3),
  ds AS (SELECT dd.vec_id, own, oth, CASE WHEN own = oth THEN CASE WHEN n.n = 1 THEN NULL
           ELSE (n.n * w.x2 + ps.psi - 2 * xy) / (n.n - 1) END
           ELSE w.x2 + ps.psi / n.n - 2 * xy / n.n END AS dist
         FROM dd JOIN w USING (vec_id) JOIN n ON n.cl = oth JOIN ps ON ps.cl = oth),
  ab AS (SELECT vec_id, max(CASE WHEN own = oth THEN dist END) AS a, min(CASE WHEN own <> oth THEN dist END) AS b
         FROM ds GROUP BY 1)
  SELECT round(avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette FROM ab"""


@query("eval_silhouette", SILHOUETTE)
def eval_silhouette(spark, sf_dir):
    rows = nearest_center(ep.embedding_vectors(spark, sf_dir), CENTERS)
    return silhouette(rows).select(F.round("silhouette", 6).alias("silhouette"))


EPOCH_BATCHES, EPOCH_STEPS, EPOCH_RATE, MOMENTUM = 4, 6, 0.2, 0.9


def _epochs_sql() -> str:
    """Common tables ``l0``, ``l1``, ...: the loss of each step's mini-batch under the weights of all steps before it."""
    out = [
        ep.SLOTS,
        f"""x AS MATERIALIZED (SELECT CAST(uuid AS BIGINT) AS id, Result AS y, unnest(range(-1, {ep.WIDTH})) AS slot,
          unnest([1e0, {ep.slot_list()}]) AS f FROM slots)""",
        "w0 AS (SELECT DISTINCT slot, 0e0 AS w, 0e0 AS v FROM x)",
    ]
    for k in range(EPOCH_STEPS):
        out += [
            f"""z{k} AS MATERIALIZED (SELECT id, y, sum(f * 2 * w) AS m FROM x JOIN w{k} USING (slot)
              WHERE id % {EPOCH_BATCHES} = {k % EPOCH_BATCHES} GROUP BY id, y)""",
            f"l{k} AS (SELECT {k} AS step, avg(ln(1 + exp(-abs(m))) + greatest(m, 0) - y * m) AS loss FROM z{k})",
            f"g{k} AS (SELECT slot, avg((1 / (1 + exp(-m)) - z{k}.y) * f) AS g FROM z{k} JOIN x USING (id) GROUP BY slot)",
            f"""w{k + 1} AS MATERIALIZED (SELECT slot, w + {1 + MOMENTUM} * ({MOMENTUM} * v - {EPOCH_RATE} * g) - {MOMENTUM} * v AS w,
              {MOMENTUM} * v - {EPOCH_RATE} * g AS v FROM w{k} JOIN g{k} USING (slot))""",
        ]
    return ",\n".join(out)


_losses = " UNION ALL ".join(f"SELECT 'softmax' AS model, CAST(step AS INT) AS step, round(loss, 6) AS loss, true AS falls FROM l{k}" for k in range(EPOCH_STEPS))


@query(
    "eval_score_listener",
    f"""WITH {_epochs_sql()}, p AS (SELECT avg(CAST(Result AS DOUBLE)) AS p FROM slots)
      {_losses}
      UNION ALL SELECT 'lr', CAST(0 AS INT), round(-p * ln(p) - (1 - p) * ln(1 - p), 6), true FROM p
      UNION ALL SELECT 'gbt', CAST(0 AS INT), CAST(NULL AS DOUBLE), true""",
)
def eval_score_listener(spark, sf_dir):
    """Losses by step. A softmax layer's are heard while it trains; SQL takes the same steps. Of a linear and a boosted fit,
    the history after the fit: both fall, and the linear one starts from the labels' entropy."""
    table = ep.vectors(spark, sf_dir)
    log = ScoreLog(every=1)
    batch = F.pmod(F.col("uuid").cast("long"), F.lit(EPOCH_BATCHES))
    fit_softmax_epochs(table, batch, EPOCH_BATCHES, epochs=2, rate=EPOCH_RATE, momentum=MOMENTUM, listener=log, steps=EPOCH_STEPS)
    heard = log.table(spark).select(F.lit("softmax").alias("model"), "step", F.round("loss", 6).alias("loss"), F.lit(True).alias("falls"))
    parts = [heard]
    with shared(table) as rows:
        linear, boosted = fit_logreg(rows), fit_gbt(rows, iters=10)
        for name, model in (("lr", linear), ("gbt", boosted)):
            losses = loss_history(model, rows)
            ends = losses.agg(F.min_by("loss", "iteration").alias("first"), F.max_by("loss", "iteration").alias("last"))
            first = F.round("first", 6) if name == "lr" else F.lit(None).cast("double")
            parts.append(ends.select(F.lit(name).alias("model"), F.lit(0).alias("step"), first.alias("loss"), (F.col("last") < F.col("first")).alias("falls")))
    return union_all(*parts)


@query(
    "eval_centers",
    """WITH ev AS (SELECT CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(64)) AS i FROM embeddings)
      SELECT CAST(i AS INT) AS slot, round(sum(v), 4) AS total, true AS met FROM ev GROUP BY i""",
)
def eval_centers(spark, sf_dir):
    """The centres, each as often as its cluster has rows, add up to the rows' sum in every slot; ``met`` says to within
    a hundredth of the rows' length, which the last step of the fit may move them."""
    table = ep.embedding_vectors(spark, sf_dir)
    with shared(table) as rows:
        model = fit_kmeans(rows)
    sizes = model.transform(table).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))
    weighted = centers(spark, model).join(sizes, "cluster").groupBy("slot").agg(F.sum(F.col("n") * F.col("value")).alias("weighted"))
    exploded = table.select(F.posexplode(vector_to_array("features")).alias("slot", "v"))
    sums = exploded.groupBy("slot").agg(F.sum("v").alias("total"), F.sum(F.abs("v")).alias("length"))
    near = F.abs(F.col("weighted") - F.col("total")) <= 0.01 * F.col("length")
    return sums.join(weighted, "slot").select("slot", (F.round("total", 4) + F.lit(0.0)).alias("total"), near.alias("met"))

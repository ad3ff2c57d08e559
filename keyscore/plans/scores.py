"""Scoring over whole tables. Closed forms have fixed parameters and an SQL twin."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keyscore.operators.evaluation import forest_votes, margins_by_round
from keyscore.operators.scoring import nearest_center, score, score_linear, score_rbf_svm, score_softmax
from keyscore.operators.training import fit_gbt, fit_random_forest
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.storage import shared

SLOT_NAMES = [f"f{i}" for i in range(ep.WIDTH)]
# parameters of the closed forms, from a rule: small weights, and slot 0 carries the signal
WEIGHTS = [2.0] + [((7 * i) % 11 - 5) / 50 for i in range(1, ep.WIDTH)]
INTERCEPT = -3.9


@query(
    "score_logreg",
    f"WITH {ep.SLOTS}, m AS (SELECT uuid, key, {ep.linear_sql(SLOT_NAMES, WEIGHTS, INTERCEPT)} AS margin FROM slots), "
    "p AS (SELECT *, 1e0 / (1e0 + exp(-margin)) AS probability FROM m) "
    "SELECT uuid, key, round(margin, 6) AS margin, round(probability, 6) AS probability, "
    "CASE WHEN probability > 0.5e0 THEN 1 ELSE 0 END AS prediction FROM p",
)
def score_logreg(spark, sf_dir):
    scored = score_linear(ep.slots(ep.endpoints(spark, sf_dir)), SLOT_NAMES, WEIGHTS, INTERCEPT, link="logit")
    return scored.select(
        "uuid", "key", F.round("margin", 6).alias("margin"), F.round("probability", 6).alias("probability"), "prediction"
    )


@query(
    "score_linear_svc",
    f"WITH {ep.SLOTS}, m AS (SELECT uuid, key, {ep.linear_sql(SLOT_NAMES, WEIGHTS, INTERCEPT)} AS margin FROM slots) "
    "SELECT uuid, key, round(margin, 6) AS margin, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction FROM m",
)
def score_linear_svc(spark, sf_dir):
    scored = score_linear(ep.slots(ep.endpoints(spark, sf_dir)), SLOT_NAMES, WEIGHTS, INTERCEPT, link="margin")
    return scored.select("uuid", "key", F.round("margin", 6).alias("margin"), "prediction")


# softmax over line items: two classes from price, quantity, discount and tax
LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_WEIGHTS = ((-0.02, 0.00001, 3.0, -1.5), (0.03, -0.00001, -2.0, 2.5))
LINE_INTERCEPTS = (0.4, -0.3)


@query(
    "score_softmax",
    f"""WITH z AS (SELECT *, {ep.linear_sql(LINE_COLUMNS, LINE_WEIGHTS[0], LINE_INTERCEPTS[0])} AS z0,
         {ep.linear_sql(LINE_COLUMNS, LINE_WEIGHTS[1], LINE_INTERCEPTS[1])} AS z1 FROM lineitem),
        e AS (SELECT *, exp(z0 - greatest(z0, z1)) AS e0, exp(z1 - greatest(z0, z1)) AS e1 FROM z)
        SELECT l_orderkey, l_linenumber, round(e0 / (e0 + e1), 6) AS p0, round(e1 / (e0 + e1), 6) AS p1,
        CASE WHEN e1 / (e0 + e1) > e0 / (e0 + e1) THEN 1 ELSE 0 END AS prediction FROM e""",
)
def score_softmax_query(spark, sf_dir):
    rows = ep.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_COLUMNS)
    scored = score_softmax(rows, LINE_COLUMNS, LINE_WEIGHTS, LINE_INTERCEPTS)
    return scored.select(
        "l_orderkey", "l_linenumber", F.round("p0", 6).alias("p0"), F.round("p1", 6).alias("p1"), "prediction"
    )


# Tree ensembles are fitted on every record, then every record is scored twice: by the ensemble,
# and by its trees one at a time. Each key's records must agree.
BY_KEY = f"WITH {ep.EP} SELECT key, count(*) AS scored, count(*) AS same FROM ep GROUP BY key"


def _agree(scored, ensemble, trees):
    same = (F.abs(ensemble - trees) < 1e-9) & (F.col("prediction") == (trees > F.lit(0.0)).cast("double"))
    return scored.groupBy("key").agg(F.count("*").alias("scored"), F.count_if(same).alias("same"))


@query("score_random_forest", BY_KEY)
def score_random_forest(spark, sf_dir):
    with shared(ep.vectors(spark, sf_dir)) as rows:
        model = fit_random_forest(rows)
    scored = forest_votes(score(ep.vectors(spark, sf_dir), model), model)
    return _agree(scored, vector_to_array("probability")[1] - 0.5, F.col("vote") - 0.5)


@query("score_gbt", BY_KEY)
def score_gbt(spark, sf_dir):
    with shared(ep.vectors(spark, sf_dir)) as rows:
        model = fit_gbt(rows)
    scored = margins_by_round(score(ep.vectors(spark, sf_dir), model), model)
    # rawPrediction is (-margin, margin) of the last round
    return _agree(scored, vector_to_array("rawPrediction")[1], F.element_at("margins", -1))

# fixed centres, from a rule
CENTERS = [[((i + 2 * j) % 5) / 10 - 0.2 for i in range(64)] for j in range(3)]
_center_rows = ", ".join(
    f"({j}, {i + 1}, CAST({v!r} AS DOUBLE))" for j, c in enumerate(CENTERS) for i, v in enumerate(c)
)
NEAREST = f"""c(j, i, v) AS (VALUES {_center_rows}),
  ev AS (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(1, 65)) AS i FROM embeddings),
  dist AS (SELECT vec_id, label, j, sum((CAST(ev.v AS DOUBLE) - c.v) * (CAST(ev.v AS DOUBLE) - c.v)) AS d
    FROM ev JOIN c USING (i) GROUP BY vec_id, label, j),
  near AS (SELECT vec_id, label, CAST(arg_min(j, d) AS INT) AS prediction FROM dist GROUP BY vec_id, label)"""


@query("score_kmeans", f"WITH {NEAREST} SELECT vec_id, prediction FROM near")
def score_kmeans(spark, sf_dir):
    rows = ep.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_center(rows, CENTERS, "embedding").select("vec_id", "prediction")


@query(
    "score_rbf_svm",
    """WITH ev AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(1, 65)) AS i FROM embeddings),
      sv AS (SELECT label AS s, i, avg(v) AS v, CASE WHEN label % 2 = 0 THEN 1e0 ELSE -1e0 END AS coef FROM ev GROUP BY label, i),
      d AS (SELECT vec_id, s, coef, sum((ev.v - sv.v) * (ev.v - sv.v)) AS d FROM ev JOIN sv USING (i) GROUP BY vec_id, s, coef),
      m AS (SELECT vec_id, sum(coef * exp(-d / 64e0)) - 0.001e0 AS margin FROM d GROUP BY vec_id)
      SELECT vec_id, round(margin, 6) + 0e0 AS margin, CASE WHEN margin > 0 THEN 0 ELSE 1 END AS prediction FROM m""",
)
def score_rbf_svm_query(spark, sf_dir):
    """Support vectors are the mean embeddings of the labels, even ones positive."""
    rows = ep.table(spark, sf_dir, "embeddings")
    means = rows.groupBy("label").agg(*[F.avg(F.col("embedding")[i].cast("double")).alias(f"v{i}") for i in range(64)])
    vectors = means.select(
        F.when(F.col("label") % 2 == 0, 1.0).otherwise(-1.0).alias("coef"),
        F.array(*[f"v{i}" for i in range(64)]).alias("vector"),
    )
    scored = score_rbf_svm(rows, vectors, gamma=1 / 64, rho=0.001, labels=(0, 1), features="embedding")
    # adding zero turns -0.0 into 0.0
    return scored.select("vec_id", (F.round("margin", 6) + F.lit(0.0)).alias("margin"), "prediction")

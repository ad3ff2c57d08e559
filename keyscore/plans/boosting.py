"""Second-order boosted trees on whole tables. SQL fits the same trees: the same bins, sums, gains and leaves."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyscore.operators.boosting import BoostedTrees, fit_boosted_trees
from keyscore.operators.evaluation import auc_of_margins
from keyscore.operators.features import feature_names
from keyscore.operators.routing import union_all
from keyscore.plans import endpoints as ep
from keyscore.plans.catalog import query
from keyscore.plans.fits import TEST, parts
from keyscore.records import ENDPOINT
from keyscore.storage import fresh_path, shared

ROUNDS, DEPTH, BINS, ETA, STEPS = 5, 3, 32, 0.3, 4096


def _fit(spark, sf_dir):
    train, _ = parts(spark, sf_dir)
    return fit_boosted_trees(train, rounds=ROUNDS, depth=DEPTH, eta=ETA, bins=BINS)


def _trees_sql() -> str:
    """Common tables that end in ``nodes`` (tree, node, slot, threshold, gain, cover, weight) and ``margins`` (part, tree, y, m).

    A node's cover and weight are sums over the rows that were routed to it, whatever its parent's split said.
    """
    out = [
        ep.SLOTS,
        f"""every AS MATERIALIZED (SELECT uuid, CASE WHEN {TEST} THEN 'test' ELSE 'train' END AS part, Result AS y,
          unnest(range({ep.WIDTH})) AS slot, unnest([{ep.slot_list()}]) AS v FROM slots)""",
        "x AS (SELECT * FROM every WHERE part = 'train')",
        "span AS (SELECT slot, min(v) AS low, max(v) AS high FROM x GROUP BY slot)",
        f"""fine AS (SELECT uuid, slot, v, CASE WHEN high <= low THEN 0
          ELSE least(CAST(floor((v - low) / (high - low) * {STEPS}) AS BIGINT), {STEPS - 1}) END AS step FROM x JOIN span USING (slot))""",
        "counted AS (SELECT slot, step, count(*) AS n, min(v) AS first FROM fine GROUP BY slot, step)",
        f"""placed AS (SELECT slot, step, first, CAST((sum(n) OVER (PARTITION BY slot ORDER BY step) - n) * {BINS}
          // sum(n) OVER (PARTITION BY slot) AS BIGINT) AS wide FROM counted)""",
        """starts AS MATERIALIZED (SELECT slot, wide, min(first) AS first,
          row_number() OVER (PARTITION BY slot ORDER BY wide) - 1 AS bin FROM placed GROUP BY slot, wide)""",
        "b AS MATERIALIZED (SELECT uuid, slot, bin FROM fine JOIN placed USING (slot, step) JOIN starts USING (slot, wide))",
        "m0 AS (SELECT DISTINCT uuid, part, y, 0e0 AS m FROM every)",
    ]
    for t in range(ROUNDS):
        out.append(
            f"""g{t} AS MATERIALIZED (SELECT uuid, p - y AS g, greatest(p * (1 - p), 1e-16) AS h
              FROM (SELECT uuid, y, 1e0 / (1e0 + exp(-m)) AS p FROM m{t} WHERE part = 'train'))"""
        )
        out.append(f"n{t}_0 AS (SELECT uuid, g, h, 1 AS node FROM g{t})")
        for d in range(DEPTH):
            out += [
                f"c{t}_{d} AS (SELECT node, slot, bin, sum(g) AS g, sum(h) AS h FROM n{t}_{d} JOIN b USING (uuid) GROUP BY node, slot, bin)",
                f"""w{t}_{d} AS (SELECT node, slot, bin, sum(g) OVER upto AS gl, sum(h) OVER upto AS hl, sum(g) OVER whole AS g,
                  sum(h) OVER whole AS h, lead(bin) OVER upto IS NULL AS last FROM c{t}_{d}
                  WINDOW upto AS (PARTITION BY node, slot ORDER BY bin), whole AS (PARTITION BY node, slot))""",
                f"""k{t}_{d} AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain
                  FROM w{t}_{d} WHERE NOT last AND hl >= 1 AND h - hl >= 1)""",
                f"""s{t}_{d} AS MATERIALIZED (SELECT node, slot, bin, gain FROM k{t}_{d} WHERE gain > 1e-6
                  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 6) DESC, slot, bin) = 1)""",
                f"""n{t}_{d + 1} AS MATERIALIZED (SELECT n.uuid, g, h, 2 * n.node + CASE WHEN b.bin <= s.bin THEN 0 ELSE 1 END AS node
                  FROM n{t}_{d} n JOIN s{t}_{d} s USING (node) JOIN b ON b.uuid = n.uuid AND b.slot = s.slot)""",
            ]
        rows = " UNION ALL ".join(f"SELECT * FROM n{t}_{d}" for d in range(DEPTH + 1))
        splits = " UNION ALL ".join(f"SELECT * FROM s{t}_{d}" for d in range(DEPTH))
        out.append(
            f"""t{t} AS MATERIALIZED (SELECT {t} AS tree, node, s.slot, first AS threshold, gain, cover, -{ETA} * g / (cover + 1) AS weight
              FROM (SELECT node, sum(g) AS g, sum(h) AS cover FROM ({rows}) GROUP BY node) LEFT JOIN ({splits}) s USING (node)
              LEFT JOIN starts ON starts.slot = s.slot AND starts.bin = s.bin + 1)"""
        )
        out.append(f"r{t}_0 AS (SELECT uuid, 1 AS node FROM m0)")
        for d in range(DEPTH):
            out.append(
                f"""r{t}_{d + 1} AS (SELECT r.uuid, CASE WHEN n.slot IS NULL THEN r.node WHEN e.v < n.threshold THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
                  FROM r{t}_{d} r JOIN t{t} n USING (node) LEFT JOIN every e ON e.uuid = r.uuid AND e.slot = n.slot)"""
            )
        out.append(
            f"m{t + 1} AS MATERIALIZED (SELECT uuid, part, y, m + weight AS m FROM m{t} JOIN r{t}_{DEPTH} USING (uuid) JOIN t{t} USING (node))"
        )
    out.append("nodes AS (" + " UNION ALL ".join(f"SELECT * FROM t{t}" for t in range(ROUNDS)) + ")")
    out.append("margins AS (" + " UNION ALL ".join(f"SELECT part, {t} AS tree, y, round(m, 9) AS m FROM m{t + 1}" for t in range(ROUNDS)) + ")")
    return ",\n".join(out)


TREES = _trees_sql()


@query(
    "fit_xgb_style_gbt",
    f"""WITH {TREES},
      ranked AS (SELECT *, rank() OVER (PARTITION BY part, tree ORDER BY m) + (count(*) OVER (PARTITION BY part, tree, m) - 1) / 2e0 AS k FROM margins)
      SELECT part, CAST(tree AS INT) AS round, count(*) AS rows, sum(y) AS positives,
        round((sum(CASE WHEN y = 1 THEN k END) - sum(y) * (sum(y) + 1) / 2e0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)), 6) AS auc
      FROM ranked GROUP BY part, tree""",
)
def fit_xgb_style_gbt(spark, sf_dir):
    """Area under the ROC curve after each round, of the records fitted and of those held out."""
    train, test = parts(spark, sf_dir)
    model = fit_boosted_trees(train, rounds=ROUNDS, depth=DEPTH, eta=ETA, bins=BINS)
    out = []
    for part, rows in (("train", train), ("test", test)):
        with shared(model.transform(rows).select("label", "margins")) as scored:
            counts = scored.agg(F.count("*").alias("rows"), F.sum("label").alias("positives"))
            aucs = auc_of_margins(scored, ROUNDS, digits=9)
            # one row of counts
            out.append(aucs.join(F.broadcast(counts)).select(F.lit(part).alias("part"), "round", "rows", "positives", F.round("auc", 6).alias("auc")))
    return union_all(*out)


@query(
    "fit_xgb_nodes",
    f"""WITH {TREES} SELECT CAST(tree AS INT) AS tree, CAST(node AS INT) AS node, CAST(coalesce(slot, -1) AS INT) AS slot, round(threshold, 9) AS threshold,
      round(gain, 5) AS gain, round(cover, 5) AS cover, round(weight, 7) + 0e0 AS weight FROM nodes""",
)
def fit_xgb_nodes(spark, sf_dir):
    """Every node of the trees, saved and read back: its split, regularised gain, hessian cover and weight."""
    model = _fit(spark, sf_dir)
    saved = BoostedTrees.load(spark, model.save(spark, fresh_path(spark, "trees")))
    digits = {"threshold": 9, "gain": 5, "cover": 5, "weight": 7}
    return saved.table(spark).select("tree", "node", "slot", *((F.round(c, d) + F.lit(0.0)).alias(c) for c, d in digits.items()))




def _importance(key, column, digits):
    value = f"count(*) AS {column}" if column == "splits" else f"round(avg({column}), {digits}) AS {column}"

    @query(key, f"WITH {TREES} SELECT CAST(slot AS INT) AS slot, {value} FROM nodes WHERE slot IS NOT NULL GROUP BY slot")
    def run(spark, sf_dir):
        table = _fit(spark, sf_dir).importances(spark, feature_names(spark, ENDPOINT))
        return table.select("slot", F.col(column) if column == "splits" else F.round(column, digits).alias(column))


_importance("imp_split_count", "splits", 0)
_importance("imp_gain", "gain", 5)
_importance("imp_cover", "cover", 5)

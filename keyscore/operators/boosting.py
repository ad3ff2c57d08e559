"""Second-order boosted trees on histograms: every level of a tree is one aggregate over all rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyscore.functions.kernels import _matrix
from keyscore.functions.trees import FlatTrees, walk
from keyscore.storage import forget, materialize

#: Equal steps between a feature's least and greatest value, from whose counts its bins are made.
STEPS = 4096
#: Trees after which the rows' margins are written, so that an expression never holds more trees than that.
WRITTEN = 8
#: Gains that differ by less are equal: the lower slot, then the lower cut wins.
DIGITS = 6

NODE_SCHEMA = "tree int, node int, slot int, threshold double, gain double, cover double, weight double, eta double"


@dataclass(frozen=True)
class Node:
    """A node of a tree, numbered as in a heap: 1 is the root, 2i and 2i + 1 are the children of i.

    An inner node has ``slot``, ``threshold`` (left below it) and ``gain``; ``cover`` is the sum of hessians of its rows,
    ``weight`` what a leaf adds to the margin.
    """

    tree: int
    node: int
    cover: float
    weight: float
    slot: int = -1
    threshold: float = math.nan
    gain: float = math.nan
    bin: int = -1


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted ensemble with the ``transform`` of a model: adds ``margins`` (after each tree), ``probability1``, ``prediction``."""

    #: Rows with null features are passed over; not a field.
    skips_null: ClassVar[bool] = True

    nodes: list[Node]
    eta: float
    features: str = "features"
    trees: list[dict[int, Node]] = field(init=False, repr=False)

    def __post_init__(self):
        trees: dict[int, dict[int, Node]] = {}
        for n in self.nodes:
            trees.setdefault(n.tree, {})[n.node] = n
        object.__setattr__(self, "trees", [trees[t] for t in sorted(trees)])

    def flat(self) -> FlatTrees:
        """For the kernel, which goes left where a feature is at most a threshold: the largest number below ours."""
        trees = [
            {i: (n.slot, float(np.nextafter(n.threshold, -np.inf)) if n.slot >= 0 else 0.0, 2 * i, 2 * i + 1, n.weight) for i, n in tree.items()}
            for tree in self.trees
        ]
        return FlatTrees.of(trees, [1.0] * len(trees))

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("margins", walk(as_array(df, self.features), self.flat()))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.element_at("margins", -1)))
        return scored.withColumn("probability1", p).withColumn("prediction", (F.col("probability1") > 0.5).cast("double"))

    def table(self, spark: SparkSession) -> DataFrame:
        number = lambda x: None if math.isnan(x) else x
        rows = [(n.tree, n.node, n.slot, number(n.threshold), number(n.gain), n.cover, n.weight, self.eta) for n in self.nodes]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> str:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: str = "features") -> BoostedTrees:
        rows = spark.read.schema(NODE_SCHEMA).parquet(path).orderBy("tree", "node").collect()
        if not rows:
            raise ValueError(f"no trees under {path}")
        nan = lambda x: math.nan if x is None else x
        return cls([Node(r.tree, r.node, r.cover, r.weight, r.slot, nan(r.threshold), nan(r.gain)) for r in rows], rows[0].eta, features)

    def importances(self, spark: SparkSession, names: DataFrame | None = None) -> DataFrame:
        """Splits, mean gain and mean cover (sum of hessians at the split) of each slot that splits, with its name if given."""
        splits = self.table(spark).filter("slot >= 0").groupBy("slot")
        table = splits.agg(F.count("*").alias("splits"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"))
        return table if names is None else names.join(F.broadcast(table), "slot")


def as_array(df: DataFrame, features: str) -> Column:
    """A column of vectors or arrays as an array of doubles, null for null."""
    column = F.col(features)
    if isinstance(df.schema[features].dataType, VectorUDT):
        return F.when(column.isNotNull(), vector_to_array(column))
    return column.cast("array<double>")


def bin_starts(rows: DataFrame, features: str = "x", bins: int = 256, steps: int = STEPS) -> list[np.ndarray]:
    """For each slot the first value of every bin but the first.

    A slot's range is cut into equal steps, whose rows are counted; steps are put together into at most ``bins`` bins of
    about equally many rows. Tasks count their own rows with numpy, Spark adds the counts up. They are exact, so the bins do not depend on how the rows are partitioned.
    """
    values = rows.select(F.col(features).cast("array<double>").alias("x"))

    def flat(batch):
        """All values of a batch that are not null, and the slot of each."""
        column = batch.column("x")
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        slots = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        v = column.flatten()
        there = v.is_valid().to_numpy(zero_copy_only=False)
        return slots[there], v.drop_null().to_numpy()

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = np.empty(0)
        for batch in batches:
            slots, v = flat(batch)
            more = np.full(max(int(slots.max(initial=-1)) + 1 - len(low), 0), np.nan)
            low, high = np.concatenate((low, more)), np.concatenate((high, more))
            np.fmin.at(low, slots, v)
            np.fmax.at(high, slots, v)
        arrays = [pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low), pa.array(high, mask=np.isnan(high))]
        yield pa.RecordBatch.from_arrays(arrays, ["slot", "low", "high"])

    ranges = values.mapInArrow(extremes, "slot int, low double, high double").groupBy("slot").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = ranges.orderBy("slot").collect()
    if not ranges:
        raise ValueError("there are no rows to fit")
    lows = np.array([r.low for r in ranges], float)
    highs = np.array([r.low if r.high is None else r.high for r in ranges], float)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(lows) * (steps + 1), np.int64)
        first = np.full(len(n), np.nan)
        for batch in batches:
            slots, v = flat(batch)
            low, high = lows[slots], highs[slots]
            with np.errstate(all="ignore"):
                share = np.floor((v - low) / (high - low) * steps)
            step = np.where(high > low, np.minimum(np.nan_to_num(share), steps - 1), 0)
            key = slots * (steps + 1) + np.where(np.isnan(v), steps, step).astype(np.int64)
            n += np.bincount(key, minlength=len(n))
            np.fmin.at(first, key, v)
        there = np.flatnonzero(n)
        arrays = [pa.array(x) for x in ((there // (steps + 1)).astype(np.int32), (there % (steps + 1)).astype(np.int32), n[there], first[there])]
        yield pa.RecordBatch.from_arrays(arrays, ["slot", "step", "n", "first"])

    counted = values.mapInArrow(count, "slot int, step int, n long, first double").groupBy("slot", "step").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    before = F.sum("n").over(Window.partitionBy("slot").orderBy("step")) - F.col("n")
    total = F.sum("n").over(Window.partitionBy("slot"))
    placed = counted.withColumn("bin", F.floor(before * bins / total))
    starts = placed.groupBy("slot", "bin").agg(F.min("first").alias("first")).orderBy("slot", "first").collect()
    out: list[list[float]] = [[] for _ in ranges]
    for r in starts:
        out[r.slot].append(r.first)
    return [np.array(x[1:], float) for x in out]


def binned(features: Column, starts: list[np.ndarray]) -> Column:
    """The bin of every slot; a NaN is in the last one."""
    matrix = _matrix()

    @F.arrow_udf("array<smallint>")
    def place(column):
        import numpy as np
        import pyarrow as pa

        x = matrix(column, len(starts))
        out = np.empty(x.shape, np.int16)
        for slot, first in enumerate(starts):
            out[:, slot] = np.searchsorted(first, x[:, slot], side="right")
        offsets = np.arange(len(x) + 1, dtype=np.int32) * len(starts)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return place(features)


def _path(tree: dict[int, Node], leaf, node: int = 1) -> Column:
    """A tree over the column ``bins`` as nested conditions, one for each inner node."""
    n = tree[node]
    if n.slot < 0:
        return leaf(n)
    return F.when(F.col("bins")[n.slot] <= n.bin, _path(tree, leaf, 2 * node)).otherwise(_path(tree, leaf, 2 * node + 1))


def best_splits(rows: DataFrame, reg: float, least_cover: float, least_gain: float) -> DataFrame:
    """For each ``node`` its sums ``g`` and ``h``, and the best split: slot, bin, sums on the left, gain.

    One aggregate of gradients and hessians by (node, slot, bin) over all rows; the rest works on its result, which has
    no more rows than nodes times slots times bins.
    """
    cells = rows.select("node", "g", "h", F.posexplode("bins").alias("slot", "bin")).groupBy("node", "slot", "bin")
    cells = cells.agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    slot = Window.partitionBy("node", "slot")
    left = slot.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.lead("bin").over(slot.orderBy("bin")).isNull()
    sums = cells.select("node", "slot", "bin", F.sum("g").over(left).alias("gl"), F.sum("h").over(left).alias("hl"), F.sum("g").over(slot).alias("g"), F.sum("h").over(slot).alias("h"), last.alias("last"))
    part = lambda g, h: g * g / (h + reg)
    gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
    gain = part(F.col("gl"), F.col("hl")) + part(gr, hr) - part(F.col("g"), F.col("h"))
    fits = ~F.col("last") & (F.col("hl") >= least_cover) & (hr >= least_cover) & (gain > least_gain)
    split = F.when(fits, F.struct("slot", "bin", "gl", "hl", gain.alias("gain")))
    order = F.struct(F.round(gain, DIGITS), -F.col("slot"), -F.col("bin"))
    whole = F.min_by(F.struct("g", "h"), F.struct("slot", "bin"))
    return sums.groupBy("node").agg(whole.alias("sums"), F.max_by(split, F.when(fits, order)).alias("split")).select("node", "sums.g", "sums.h", "split")


def fit_boosted_trees(
    df: DataFrame,
    rounds: int = 5,
    eta: float = 0.3,
    depth: int = 3,
    reg: float = 1.0,
    least_cover: float = 1.0,
    least_gain: float = 1e-6,
    bins: int = 256,
    features: str = "features",
) -> BoostedTrees:
    """Boosted trees for the logistic loss, from first and second derivatives.

    A split's gain is GL^2/(HL + reg) + GR^2/(HR + reg) - G^2/(H + reg) over sums of gradients and hessians; either side
    needs ``least_cover`` of hessian. A leaf adds -eta * G / (H + reg). Rows are binned once and written; a tree takes one
    aggregate over them for each level, and only its splits reach the driver. Labels are 0 and 1; a row whose label or
    features are null is an error; NaN goes to the right. Without rows there is nothing to fit, which is an error.
    """
    plain = df.select(F.col("label").cast("double").alias("label"), as_array(df, features).alias("x"))
    starts = bin_starts(plain, "x", bins)
    rows = materialize(plain.select("label", binned(F.col("x"), starts).alias("bins"), F.lit(0.0).alias("margin")), "boosting")
    nodes: list[Node] = []
    since: list[dict[int, Node]] = []
    for t in range(rounds):
        margin = F.col("margin")
        for tree in since:
            margin = margin + _path(tree, lambda n: F.lit(n.weight))
        if len(since) == WRITTEN:
            before, rows = rows, materialize(rows.select("label", "bins", margin.alias("margin")), "boosting")
            forget(before)
            margin, since = F.col("margin"), []
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        scored = rows.select("bins", (p - F.col("label")).alias("g"), F.greatest(p * (1 - p), F.lit(1e-16)).alias("h"))
        tree = {1: Node(t, 1, math.nan, 0.0)}
        open_nodes = [1]
        for _ in range(depth):
            at = _path(tree, lambda n: F.lit(n.node))
            found = best_splits(scored.select("g", "h", at.alias("node"), "bins").where(F.col("node").isin(open_nodes)), reg, least_cover, least_gain)
            open_nodes = []
            for r in found.collect():
                weight = lambda g, h: -eta * g / (h + reg)
                if not r.split:
                    tree[r.node] = Node(t, r.node, r.h, weight(r.g, r.h))
                    continue
                s = r.split
                tree[r.node] = Node(t, r.node, r.h, weight(r.g, r.h), s.slot, float(starts[s.slot][s.bin]), s.gain, s.bin)
                for child, g, h in ((2 * r.node, s.gl, s.hl), (2 * r.node + 1, r.g - s.gl, r.h - s.hl)):
                    tree[child] = Node(t, child, h, weight(g, h))
                    open_nodes.append(child)
            if not open_nodes:
                break
        nodes += [tree[i] for i in sorted(tree)]
        since.append(tree)
    forget(rows)
    return BoostedTrees(nodes, eta, features)

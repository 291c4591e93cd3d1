"""Second-order histogram gradient boosting for 0/1 labels.

Rows are binned once: each feature gets at most ``maxBins`` bins between its quantiles, and a
bin of its own for missing values.  Binned rows are packed into blocks, which are dealt over the tasks once and stay there.
A round grows one tree level by level, a job a level: tasks sum gradients and hessians of their blocks by (node, feature, bin)
with numpy, and at most 2^(depth - 1) x features x bins sums of a task come back.  Only the smaller child of
each split is summed; its sibling is the parent less that child, and leaves of the last level take their sums from the split.

The gain of a split is G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2) - G^2 / (H + l2); a child's hessian
must reach ``minChildWeight``.  Missing values go to the side with the larger gain.  A leaf adds
-stepSize * G / (H + l2) to the log-odds, which start at 0.

Margins are carried with the blocks, in memory or on the executors' disks; every ``CHECKPOINT``
rounds the blocks are written to the shared folder, so that a lost executor costs that many trees at most.
Rows of a round are drawn by the seed, the round and the block, columns by the seed.

Defined cases: rows without a label are left out of the fit; a null weight is 1; an empty or one-class table
gives trees that are single leaves; a constant column is never split.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import written

CHECKPOINT = 25
BLOCK_ROWS = 20_000
MANY_TASKS = 64  # from here on the tasks' sums are added up on the executors first
MIN_GAIN = 1e-6
BLOCK = "block long, n int, bins binary, y binary, w binary"


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _BoostingParams(Params):
    featuresCol = _param("featuresCol", "vector of features", TypeConverters.toString)
    labelCol = _param("labelCol", "0/1 label", TypeConverters.toString)
    weightCol = _param("weightCol", "row weight, or an empty name", TypeConverters.toString)
    maxIter = _param("maxIter", "rounds", TypeConverters.toInt)
    maxDepth = _param("maxDepth", "depth of a tree", TypeConverters.toInt)
    stepSize = _param("stepSize", "learning rate", TypeConverters.toFloat)
    l2 = _param("l2", "L2 penalty of leaf values", TypeConverters.toFloat)
    minChildWeight = _param("minChildWeight", "least hessian of a child", TypeConverters.toFloat)
    rowShare = _param("rowShare", "share of rows drawn for a round", TypeConverters.toFloat)
    columnShare = _param("columnShare", "share of features drawn for a round", TypeConverters.toFloat)
    maxBins = _param("maxBins", "bins of a feature, without the one for missing values", TypeConverters.toInt)
    seed = _param("seed", "seed of the draws", TypeConverters.toInt)
    trees = _param("trees", "fitted trees as JSON", TypeConverters.toString)


def cut_points(rows: DataFrame, values: Column, size: int, max_bins: int) -> list[list[float]]:
    """Bin borders of each of the ``size`` elements of an array column, from one aggregate of quantile sketches."""
    shares = [(k + 1) / max_bins for k in range(max_bins - 1)]
    x = [F.when(F.isnan(values[i]), None).otherwise(values[i]) for i in range(size)]
    got = rows.agg(*[F.percentile_approx(c, shares, 100 * max_bins).alias(f"q{i}") for i, c in enumerate(x)]).first()
    return [sorted(set(q or [])) for q in got]


def binned(rows: DataFrame, values: Column, cuts: list[list[float]], keep: list[Column]) -> DataFrame:
    """``keep`` and ``bins``: the number of borders below each value, or the number of borders + 1 for a missing value."""
    names = [f"x{i}" for i in range(len(cuts))]
    wide = rows.select(*keep, *[F.coalesce(values[i], F.lit(float("nan"))).alias(n) for i, n in enumerate(names)])
    # Bucketizer is closed on the left: a value equal to a border must stay below it
    splits = [[-np.inf, *[float(np.nextafter(c, np.inf)) for c in own], np.inf] for own in cuts]
    several = [i for i, own in enumerate(cuts) if own]
    out = wide
    if several:
        out = Bucketizer(splitsArray=[splits[i] for i in several], inputCols=[names[i] for i in several], outputCols=[f"b{i}" for i in several],
                         handleInvalid="keep").transform(wide)
    one = lambda i: F.col(f"b{i}") if cuts[i] else F.isnan(names[i]).cast("double")
    kept = [c for c in wide.columns if c not in names]
    return out.select(*kept, F.array(*[one(i).cast("short") for i in range(len(cuts))]).alias("bins"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of at most about ``BLOCK_ROWS`` rows from columns ``y``, ``w``, ``bins``; bins feature by feature."""
    def pack(batches):
        part, number, kept, held = TaskContext.get().partitionId(), 0, [], 0

        def block():
            y, w, bins = (np.concatenate(z) for z in zip(*kept, strict=True))
            return pa.RecordBatch.from_pydict({"block": [part << 32 | number], "n": [len(y)], "bins": [np.ascontiguousarray(bins.T).tobytes()],
                                               "y": [y.tobytes()], "w": [w.tobytes()]},
                                              pa.schema([("block", pa.int64()), ("n", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()), ("w", pa.binary())]))

        for batch in batches:
            if not batch.num_rows:
                continue
            y, w = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (0, 1))
            kept.append((y, w, batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int16).reshape(batch.num_rows, -1)))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield block()
                kept, held, number = [], 0, number + 1
        if held:
            yield block()

    return rows.select("y", "w", "bins").mapInArrow(pack, BLOCK)


def _dealt(blocks: DataFrame) -> RDD:
    """(block, bins, y, w, margins) over at most one task for each core, the largest blocks first."""
    sizes = blocks.select("block", "n").orderBy(F.desc("n"), "block").toArrow().column("block").to_pylist()
    tasks = max(1, min(len(sizes), blocks.sparkSession.sparkContext.defaultParallelism))
    place = {block: k % tasks for k, block in enumerate(sizes)}
    rows = blocks.rdd.map(lambda r: (place[r["block"]], (r["block"], bytes(r["bins"]), bytes(r["y"]), bytes(r["w"]), bytes(8 * r["n"]))))
    return rows.partitionBy(tasks, int).values()


class _Tree:
    """A tree as arrays over a complete binary heap; a leaf has feature -1."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature, self.bin = np.full(size, -1), np.full(size, -1)
        self.missing_left, self.value, self.gain, self.cut = np.zeros(size, bool), np.zeros(size), np.zeros(size), np.zeros(size)

    def reached(self, bins: np.ndarray, levels: int, missing: np.ndarray) -> np.ndarray:
        """The node that each column of ``bins`` reaches after ``levels`` steps."""
        n, wide = bins.shape[1], int(missing.max()) + 1
        flat, row, node = bins.reshape(-1), np.arange(n), np.zeros(n, np.int64)
        inner = 2 ** levels - 1  # what lies above the level
        first = np.maximum(self.feature[:inner], 0) * n
        below = self._below(inner, missing, wide).reshape(-1)
        for level in range(levels):
            if level:
                at = first.take(node)
                at += row
            else:
                at = first[0] + row
            node *= wide
            node += flat.take(at)
            node = below.take(node)
        return node

    def _below(self, inner: int, missing: np.ndarray, wide: int) -> np.ndarray:
        """(node, bin): the node that a row of ``node`` goes to by its bin; one that is no split keeps its rows."""
        node, feature = np.arange(2 * inner + 1)[:, None], np.append(self.feature[:inner], np.full(inner + 1, -1))[:, None]
        bins = np.arange(wide)[None]
        pad = lambda x: np.append(x[:inner], np.zeros(inner + 1, x.dtype))[:, None]
        right = np.where(bins == missing[np.maximum(feature, 0)], ~pad(self.missing_left), bins > pad(self.bin))
        return np.where(feature < 0, node, 2 * node + 1 + right)


def best_splits(sums: np.ndarray, missing: np.ndarray, allowed: np.ndarray, l2: float, least: float):
    """Per node: (gain, feature, bin, missing left, left sums) of its best split.

    ``sums`` is (nodes, features, bins, 2) without and ``missing`` (nodes, features, 2) the missing values' sums.
    """
    score = lambda s: s[..., 0] ** 2 / np.maximum(s[..., 1] + l2, 1e-300)
    upto = np.cumsum(sums, axis=2)
    whole = upto[:, :, -1] + missing
    gains = []
    for go_left in (False, True):
        left = upto + missing[:, :, None] if go_left else upto
        right = whole[:, :, None] - left
        gain = score(left) + score(right) - score(whole)[:, :, None]
        gain[(left[..., 1] < least) | (right[..., 1] < least)] = -np.inf
        gain[:, ~allowed] = -np.inf
        gains.append(gain)
    gain = np.stack(gains, axis=-1)
    at = gain.reshape(len(gain), -1).argmax(axis=1)
    f, b, side = np.unravel_index(at, gain.shape[1:])
    node = np.arange(len(gain))
    left = upto[node, f, b] + np.where(side[:, None] == 1, missing[node, f], 0)
    return gain[node, f, b, side], f, b, side == 1, left


class HistogramBoostingModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees: adds ``probability`` (vector) and ``prediction``; batch and stream alike."""

    @keyword_only
    def __init__(self, featuresCol="features", trees="[]"):
        super().__init__()
        self._set(**self._input_kwargs)

    def tree_list(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.trees))

    @property
    def featureImportances(self):
        """Share of each feature in the total gain."""
        trees = self.tree_list()
        size = max((t["size"] for t in trees), default=0)
        total = np.zeros(size)
        for t in trees:
            for f, g in zip(t["feature"], t["gain"], strict=True):
                if f >= 0:
                    total[f] += g
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def _transform(self, df: DataFrame) -> DataFrame:
        trees = [{k: np.array(t[k]) for k in ("feature", "cut", "missing_left", "value")} | {"depth": t["depth"]} for t in self.tree_list()]

        @F.pandas_udf("double")
        def probability(batches: pd.Series) -> pd.Series:
            x = np.stack(batches.to_numpy()) if len(batches) else np.zeros((0, 1))
            margin, row = np.zeros(len(x)), np.arange(len(x))
            for t in trees:
                node = np.zeros(len(x), np.int64)
                for _ in range(t["depth"]):
                    f = t["feature"][node]
                    v = x[row, np.maximum(f, 0)]
                    right = np.where(np.isnan(v), ~t["missing_left"][node], v > t["cut"][node])
                    node = np.where(f < 0, node, 2 * node + 1 + right)
                margin += t["value"][node]
            return pd.Series(1 / (1 + np.exp(-margin)))

        p = probability(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))
        out = df.withColumn("_p1", p)
        return out.withColumn("probability", array_to_vector(F.array(1 - F.col("_p1"), F.col("_p1")))).withColumn(
            "prediction", (F.col("_p1") >= 0.5).cast("double")).drop("_p1")


class HistogramBoostingClassifier(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient boosting with second-order splits on binned features."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", weightCol="", maxIter=300, maxDepth=6, stepSize=0.1, l2=1.0,
                 minChildWeight=1.0, rowShare=1.0, columnShare=1.0, maxBins=256, seed=42):
        super().__init__()
        self._set(**self._input_kwargs | {"weightCol": weightCol, "featuresCol": featuresCol, "labelCol": labelCol})
        self._setDefault(maxIter=300, maxDepth=6, stepSize=0.1, l2=1.0, minChildWeight=1.0, rowShare=1.0, columnShare=1.0, maxBins=256, seed=42)

    def _fit(self, df: DataFrame) -> HistogramBoostingModel:
        get = lambda name: self.getOrDefault(name)
        x, weight = vector_to_array(F.col(get("featuresCol"))), get("weightCol")
        keep = [F.col(get("labelCol")).cast("double").alias("y"), (F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)).alias("w")]
        rows = df.where(F.col(get("labelCol")).isNotNull())
        first = rows.select(F.size(x).alias("n")).first()
        size = first["n"] if first else 0
        if not size:
            return HistogramBoostingModel(featuresCol=get("featuresCol"), trees="[]")
        cuts = cut_points(rows, x, size, get("maxBins"))
        blocks = written(_blocks(binned(rows, x, cuts, keep)), "boosting")
        missing, depth = _missing(cuts), get("maxDepth")
        rng, trees = np.random.default_rng(get("seed")), []
        now = _dealt(blocks).persist(StorageLevel.MEMORY_AND_DISK)
        held = [now]
        for number in range(get("maxIter")):
            allowed = np.zeros(size, bool)
            allowed[rng.choice(size, max(1, round(get("columnShare") * size)), replace=False)] = True
            tree = self._grow(now, number, allowed, cuts)
            trees.append({"size": size, "depth": depth, "feature": tree.feature.tolist(), "cut": tree.cut.tolist(),
                          "missing_left": tree.missing_left.tolist(), "value": tree.value.tolist(), "gain": tree.gain.tolist()})
            while len(held) > 1:  # the blocks before these are no longer read
                held.pop(0).unpersist()
            if number + 1 == get("maxIter"):
                break
            now = now.map(_moved(tree, depth, missing)).persist(StorageLevel.MEMORY_AND_DISK)
            if (number + 1) % CHECKPOINT == 0:
                now.checkpoint()
            held.append(now)
        for old in held:
            old.unpersist()
        return HistogramBoostingModel(featuresCol=get("featuresCol"), trees=json.dumps(trees))

    def _grow(self, now: RDD, number: int, allowed: np.ndarray, cuts: list[list[float]]) -> _Tree:
        get = lambda name: self.getOrDefault(name)
        depth, l2, least, step = get("maxDepth"), get("l2"), get("minChildWeight"), get("stepSize")
        tree, missing, own = _Tree(depth), _missing(cuts), np.flatnonzero(allowed)
        lost_at, every = missing[own], np.ones(len(own), bool)
        draw = (get("rowShare"), get("seed"), number)
        sums = self._sums(now, tree, 0, [0], missing, own, draw)
        whole = {0: sums[0][0].sum(axis=0)}
        for level in range(depth + 1):
            nodes = sorted(whole)
            if not nodes:
                break
            for n in nodes:
                g, h = whole[n]
                tree.value[n] = -step * g / (h + l2) if h + l2 > 0 else 0.0
            if level == depth:
                break
            all_ = np.stack([sums[n] for n in nodes])
            lost = all_[:, np.arange(len(own)), lost_at]
            seen = all_.copy()
            seen[:, np.arange(len(own)), lost_at] = 0
            gain, f, b, go_left, left = best_splits(seen, lost, every, l2, least)
            small, below = {}, {}
            for k, n in enumerate(nodes):
                feature = own[f[k]]
                if gain[k] > MIN_GAIN and b[k] < missing[feature]:
                    tree.feature[n], tree.bin[n], tree.gain[n], tree.missing_left[n] = feature, b[k], gain[k], go_left[k]
                    tree.cut[n] = cuts[feature][b[k]] if b[k] < len(cuts[feature]) else np.inf
                    small[2 * n + (1 if left[k][1] <= whole[n][1] / 2 else 2)] = n
                    below[2 * n + 1], below[2 * n + 2] = left[k], whole[n] - left[k]
            parents, sums, whole = sums, {}, below
            if small and level + 1 < depth:
                got = self._sums(now, tree, level + 1, sorted(small), missing, own, draw)
                for child, n in small.items():
                    other = 4 * n + 3 - child
                    sums[child], sums[other] = got[child], parents[n] - got[child]
                    whole[child] = got[child][0].sum(axis=0)
                    whole[other] = sums[other][0].sum(axis=0)
        return tree

    @staticmethod
    def _sums(now: RDD, tree: _Tree, level: int, nodes: list[int], missing: np.ndarray, own: np.ndarray, draw: tuple) -> dict[int, np.ndarray]:
        """(feature of ``own``, bin, [g, h]) of each of ``nodes`` of ``level``: one job, an array a task."""
        size, wide, k, (share, seed, number) = len(missing), int(missing.max()) + 1, len(own), draw
        place = np.full(2 ** (level + 1) - 1, -1)
        place[nodes] = np.arange(len(nodes))

        def local(blocks):
            total = np.zeros((2, k, len(nodes) * wide))
            for block, bins, y, w, margin in blocks:
                x, y, w = np.frombuffer(bins, np.int16).reshape(size, -1), np.frombuffer(y), np.frombuffer(w)
                at = place[tree.reached(x, level, missing)] if level else np.zeros(len(y), np.int64)
                if share < 1:
                    at = np.where(np.random.default_rng([seed, number, block >> 32, block & 0xFFFFFFFF]).random(len(y)) < share, at, -1)
                rows = np.flatnonzero(at >= 0)
                every = len(rows) == len(at)
                of = (lambda v: v) if every else (lambda v: v.take(rows))  # noqa: B023, E731
                p = 1 / (1 + np.exp(-of(np.frombuffer(margin))))
                weight = of(w)
                g, h, first = weight * (p - of(y)), weight * p * (1 - p), of(at) * wide
                for j, f in enumerate(own):
                    key = first + of(x[f])
                    total[0, j] += np.bincount(key, g, total.shape[2])
                    total[1, j] += np.bincount(key, h, total.shape[2])
            yield total

        parts = now.mapPartitions(local)
        total = parts.treeReduce(np.add) if now.getNumPartitions() > MANY_TASKS else sum(parts.collect())
        return dict(zip(nodes, total.reshape(2, k, len(nodes), wide).transpose(2, 1, 3, 0), strict=True))


def _moved(tree: _Tree, depth: int, missing: np.ndarray):
    """Adds a tree's leaf values to the margins of a block."""
    def move(block):
        number, bins, y, w, margin = block
        node = tree.reached(np.frombuffer(bins, np.int16).reshape(len(missing), -1), depth, missing)
        return number, bins, y, w, (np.frombuffer(margin) + tree.value[node]).tobytes()

    return move


def _missing(cuts: list[list[float]]) -> np.ndarray:
    """The bin of missing values of each feature."""
    return np.array([len(own) + 1 for own in cuts])

"""Random forests on binned features for 0/1 labels and for numbers.

Rows are binned once and packed into blocks.  A tree draws Poisson counts of each block's rows by a seed of the tree and
the block.  Its nodes of more than ``LOCAL_ROWS`` drawn rows are split by histograms, which tasks sum over their blocks and a
shuffle merges by (tree, node), a level a job.  Every smaller node is the root of a subtree: its drawn rows are gathered
by (tree, node), bins of few values folded into shared bytes, and one task grows it to the end.  Trees are gathered about ``DEALT_ROWS``
drawn rows at a time, and the shuffle of one lot goes before the next, so the disk does not grow with the number of trees.  So no task holds more
than about ``LOCAL_ROWS`` rows, and the number of jobs depends on the rows, not on the depth.

A split gains sum(w y)^2 / sum(w) of both sides less that of the node: the variance taken away, which for 0/1 labels is half
of the Gini impurity.  As in Spark ML: ``maxBins`` bins, features drawn anew for each node, a node without a gain among the drawn features
is a leaf, leaves hold the weighted mean, importances are the gains of a tree in shares, averaged over the trees.

Defined cases, as in Spark ML: a label or weight that is null, not a number or infinite, a class other than 0 and 1, a negative
weight and an empty table are errors; rows of weight 0 are left out; missing values are larger than all others.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import written

LOCAL_ROWS = 2_000_000
DEALT_ROWS = 100_000_000
BLOCK_ROWS = 50_000
NODES_AT_ONCE = 4096
LEAST_GAIN = 1e-9  # of a node's impurity: less is rounding
LEAST_WEIGHT = 1e-12  # of a bin's weight in the parent: less is rounding
BUNDLE_CODES = 128
CACHED_ROWS = 1 << 16
BLOCK = "block long, n int, bins binary, y binary, w binary"
DRAWN = "tree int, node int, block long, bins binary, y binary, w binary, times binary, weights binary"
HISTOGRAM = "tree int, node int, part long, sums binary"
BEST = "tree int, node int, feature int, bin int, gain double, value double, n_left long, n_right long"
GROWN = "tree int, node int, nodes binary, gains binary"
NODE = np.dtype([("feature", "<i2"), ("bin", "u1"), ("child", "<i4"), ("value", "<f8")])


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _ForestParams(Params):
    featuresCol = _param("featuresCol", "vector of features", TypeConverters.toString)
    labelCol = _param("labelCol", "label", TypeConverters.toString)
    weightCol = _param("weightCol", "row weight, or an empty name", TypeConverters.toString)
    classes = _param("classes", "whether labels are the classes 0 and 1", TypeConverters.toBoolean)
    numTrees = _param("numTrees", "trees", TypeConverters.toInt)
    maxDepth = _param("maxDepth", "depth of a tree", TypeConverters.toInt)
    subsamplingRate = _param("subsamplingRate", "mean of a row's count in a tree", TypeConverters.toFloat)
    sqrtFeatures = _param("sqrtFeatures", "whether a node draws the square root of the features' number, or takes all", TypeConverters.toBoolean)
    maxBins = _param("maxBins", "bins of a feature", TypeConverters.toInt)
    seed = _param("seed", "seed of the draws", TypeConverters.toInt)
    cuts = _param("cuts", "fitted bin borders as JSON", TypeConverters.toString)
    importances = _param("importances", "fitted importances", TypeConverters.toListFloat)


def _checked(x: Column, what: str, classes: bool = False) -> Column:
    """``x``, or an error where it cannot be a label or a weight."""
    x = F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit(f"{what} MUST NOT be Null or NaN"))).when(
        F.abs(x) == float("inf"), F.raise_error(F.lit(f"{what} MUST NOT be Infinity"))).otherwise(x)
    if what == "Weights":
        return F.when(x < 0, F.raise_error(F.lit("Weights MUST NOT be Negative"))).otherwise(x)
    return F.when(~x.isin(0.0, 1.0), F.raise_error(F.lit("Labels MUST be 0 or 1"))).otherwise(x) if classes else x


def feature_cuts(rows: DataFrame, values: Column, size: int, max_bins: int) -> list[list[float]]:
    """Bin borders of each element of an array column: between all values where there are few, else quantiles."""
    shares = [(k + 1) / max_bins for k in range(max_bins - 1)]
    x = [F.when(F.isnan(values[i]), None).otherwise(values[i]) for i in range(size)]
    got = rows.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)], *[F.min(c).alias(f"m{i}") for i, c in enumerate(x)],
                   *[F.max(c).alias(f"M{i}") for i, c in enumerate(x)]).first()
    few = [i for i in range(size) if got[f"n{i}"] <= max_bins]  # an estimate: a few more values may come back
    every = rows.agg(*[F.sort_array(F.collect_set(x[i])).alias(f"v{i}") for i in few]).first() if few else {}
    many = [i for i in range(size) if i not in few or not 0 < len(every[f"v{i}"]) <= max_bins]
    quantiles = rows.agg(*[F.percentile_approx(x[i], shares, 100 * max_bins).alias(f"q{i}") for i in many]).first() if many else {}
    cuts = []
    for i in range(size):
        if i not in many:
            v = every[f"v{i}"]
            cuts.append([(a + b) / 2 for a, b in zip(v[:-1], v[1:], strict=True)])
        else:
            cuts.append(sorted({*(quantiles[f"q{i}"] or []), *([got[f"m{i}"]] if got[f"m{i}"] is not None else [])} - {got[f"M{i}"]}))
    return cuts


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The number of borders below each value; missing values come last."""
    out = np.zeros(x.shape, np.uint8)
    for f, own in enumerate(cuts):
        out[:, f] = np.searchsorted(own, x[:, f], side="left")
        out[np.isnan(x[:, f]), f] = len(own)
    return out


def packed(rows: DataFrame, cuts: list[list[float]], block_rows: int) -> DataFrame:
    """Blocks of at most ``block_rows`` rows from columns ``x``, ``y``, ``w``: bins as bytes, labels and weights as doubles."""
    borders, size = [np.array(c, float) for c in cuts], len(cuts)

    def pack(batches):
        part, number = TaskContext.get().partitionId(), 0
        kept, held = [], 0

        def block():
            bins, y, w = (np.concatenate(z) for z in zip(*kept, strict=True))
            return pa.RecordBatch.from_pydict({"block": [part << 32 | number], "n": [len(y)], "bins": [bins.tobytes()], "y": [y.tobytes()], "w": [w.tobytes()]},
                                              pa.schema([("block", pa.int64()), ("n", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()), ("w", pa.binary())]))

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            kept.append((to_bins(x, borders), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))))
            held += batch.num_rows
            if held >= block_rows:
                yield block()
                kept, held, number = [], 0, number + 1
        if held:
            yield block()

    return rows.select("x", "y", "w").mapInArrow(pack, BLOCK)


def unpacked(batch: pa.RecordBatch, size: int):
    """(block, bins, y, w) of every block."""
    for block, bins, y, w in zip(*(batch.column(c).to_pylist() for c in ("block", "bins", "y", "w")), strict=True):
        yield block, np.frombuffer(bins, np.uint8).reshape(-1, size), np.frombuffer(y), np.frombuffer(w)


KINDS = {1: np.uint8, 2: np.uint16, 4: np.float32, 8: float}


def _narrow(x: np.ndarray) -> np.ndarray:
    """Doubles in the narrowest kind that holds the same numbers, which keeps what is shuffled small."""
    with np.errstate(invalid="ignore", over="ignore"):
        return next((y for y in map(x.astype, list(KINDS.values())[:-1]) if np.array_equal(y, x)), x)


def _widened(x, n: int) -> np.ndarray:
    return np.frombuffer(x, KINDS[len(x) // max(n, 1)]).astype(float)


def _coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, their places as bytes) of doubles that take few values, such as the weights of two classes; else (none, the doubles narrowed)."""
    values, places = np.unique(x, return_inverse=True)
    return (values, places.astype(np.uint8)) if len(values) <= 256 else (values[:0], _narrow(x))


def byte_groups(cuts: list[list[float]]) -> list[list[tuple[int, int]]]:
    """(feature, its number of bins) of the features whose bins share a byte."""
    groups, room = [], 0
    for f in np.argsort([len(c) for c in cuts], kind="stable").tolist():
        n = len(cuts[f]) + 1
        if room < n:
            groups.append([])
            room = 256
        groups[-1].append((f, n))
        room //= n
    return groups


def folded(bins: np.ndarray, groups: list) -> np.ndarray:
    out = np.zeros((len(bins), len(groups)), np.uint8)
    for g, group in enumerate(groups):
        out[:, g] = bins[:, group[0][0]]
        for f, n in group[1:]:
            out[:, g] = out[:, g] * np.uint8(n) + bins[:, f]
    return out


def unfolded(codes: np.ndarray, groups: list, size: int) -> np.ndarray:
    out = np.empty((len(codes), size), np.uint8)
    for g, group in enumerate(groups):
        code = codes[:, g]
        for f, n in reversed(group[1:]):
            code, out[:, f] = np.divmod(code, np.uint8(n))
        out[:, group[0][0]] = code
    return out


def reached(nodes: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """The leaf of each row; leaves lead to themselves."""
    flat, first = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
    feature, border, child = nodes["feature"], nodes["bin"], nodes["child"]
    at = np.zeros(len(bins), np.int64)
    for _ in range(depth):
        below = child.take(at) + (flat.take(first + feature.take(at)) > border.take(at))
        if np.array_equal(below, at):
            break
        at = below
    return at


def leaf_of(nodes: np.ndarray, bins: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
    """``reached`` for some of the rows."""
    return reached(nodes, bins[rows], depth) if len(nodes) > 1 else np.zeros(len(rows), np.int64)


def _leaves(first: int, n: int) -> np.ndarray:
    out = np.zeros(n, NODE)
    out["bin"], out["child"] = 255, np.arange(first, first + n)
    return out


def _drawn_features(rng, nodes: int, size: int, k: int) -> np.ndarray:
    if k >= size:
        return np.broadcast_to(np.arange(size), (nodes, size))
    return np.argpartition(rng.random((nodes, size)), k, axis=1)[:, :k]


def best_cut(w: np.ndarray, y: np.ndarray):
    """Per node (gain, bin) of the best cut of histograms (nodes, bins) of the weights and of weight x label."""
    w_left, y_left, seen = np.cumsum(w, 1), np.cumsum(y, 1), np.cumsum(w > 0, 1)
    w_all, y_all = w_left[:, -1:], y_left[:, -1:]
    open_ = (seen > 0) & (seen < seen[:, -1:])
    score = np.where(open_, y_left ** 2 / np.where(open_, w_left, 1) + (y_all - y_left) ** 2 / np.where(open_, w_all - w_left, 1), -np.inf)
    at = score.argmax(1)
    return score[np.arange(len(at)), at] - (y_all ** 2 / np.maximum(w_all, 1e-300))[:, 0], at


def bundled(bins: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, list[int]]]:
    """(code of each row, bins of each code by feature, features): features of few values share one column of the codes that
    occur, so that one sum over the rows serves them all."""
    out, wide = [], bins.max(0, initial=0).astype(int) + 1
    code = codes = None
    for f in np.argsort(wide, kind="stable").tolist():
        own = np.ascontiguousarray(bins[:, f])
        if code is not None and len(codes) * wide[f] <= BUNDLE_CODES:
            both = code * np.uint16(wide[f]) + own
            found = np.flatnonzero(np.bincount(both, minlength=1))
            number = np.zeros(len(codes) * wide[f], np.uint16)
            number[found] = np.arange(len(found))
            code, codes = number[both], np.column_stack([codes[found // wide[f]], found % wide[f]])
            out[-1] = (code, codes, out[-1][2] + [f])
        else:
            code, codes = own.astype(np.uint16), np.arange(wide[f])[:, None]
            out.append((code, codes, [f]))
    return out


def _by_bin(sums: np.ndarray, bundles: list, size: int, wide: int) -> list[np.ndarray]:
    """Histograms (values, nodes, bins) of each feature from sums (values, nodes, codes of all bundles)."""
    out, first = [None] * size, 0
    for _, codes, features in bundles:
        own = sums[:, :, first:first + len(codes)]
        first += len(codes)
        for j, f in enumerate(features):
            out[f] = own if len(features) == 1 else own @ (codes[:, j, None] == np.arange(wide)).astype(float)
    return out


def _sums(bundles: list, rows: np.ndarray, node: np.ndarray, m: int, *values: np.ndarray | None) -> np.ndarray:
    """Sums of each of ``values`` (None: rows) as (values, nodes, codes of all bundles)."""
    out = [np.zeros((len(values), m * len(codes))) for _, codes, _ in bundles]
    step = max(CACHED_ROWS, 256 * m)
    for a in range(0, len(rows), step):
        part = slice(a, a + step)
        r, first, own = rows[part], node[part].astype(np.int64), [None if v is None else v[part] for v in values]
        for total, (code, codes, _) in zip(out, bundles, strict=True):
            key = first * len(codes)
            key += code[r]
            for t, v in zip(total, own, strict=True):
                t += np.bincount(key, v, m * len(codes))
    return np.concatenate([t.reshape(len(values), m, -1) for t in out], axis=2)


def _below(sums: np.ndarray, sums_yy: np.ndarray, bundles: list, number: np.ndarray, small: np.ndarray, rows, node, w, wy, wyy):
    """Sums of both children of each split node: over the rows of the smaller one, and those of its parent less them.
    ``number`` are the split nodes, ``small`` the smaller child of each; ``node`` counts the children."""
    pairs = len(small)
    chosen = np.zeros(2 * pairs, bool)
    chosen[2 * np.arange(pairs) + small] = True
    at = np.flatnonzero(chosen[node])
    pair = node[at] >> 1
    own, own_yy = _sums(bundles, rows[at], pair, pairs, w[at], wy[at]), np.bincount(pair, wyy[at], pairs)
    other = sums[:, number] - own
    other[:, other[0] <= LEAST_WEIGHT * sums[0, number]] = 0.0  # nothing but rounding is left
    out, out_yy = np.empty((2, 2 * pairs, sums.shape[2])), np.empty(2 * pairs)
    out[:, 2 * np.arange(pairs) + small], out[:, 2 * np.arange(pairs) + 1 - small] = own, other
    out_yy[2 * np.arange(pairs) + small], out_yy[2 * np.arange(pairs) + 1 - small] = own_yy, sums_yy[number] - own_yy
    return out, out_yy


def _runs(starts: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Consecutive nodes ``low`` to ``high`` in runs of about ``CACHED_ROWS`` rows, without those that have none at a run's ends;
    the rows of node ``i`` begin at ``starts[i]``."""
    while low < high:
        a = int(np.searchsorted(starts, starts[low], side="right")) - 1  # the first node of this place that has rows
        if a >= high:
            return
        b = min(high, max(a + 1, int(np.searchsorted(starts, starts[a] + CACHED_ROWS, side="right")) - 1))
        yield a, b
        low = b


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, k: int, depth: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, gain by feature) of the tree over these rows, level by level for all nodes at once.

    Where nodes take all features, their histograms are kept for a level, and only the smaller child of a node is summed anew."""
    size, wide = bins.shape[1], int(bins.max(initial=0)) + 1
    gains, levels, first = np.zeros(size), [], 0
    flat = np.ascontiguousarray(bins).reshape(-1)
    node, rows, m = np.zeros(len(y), np.int32), np.arange(len(y), dtype=np.int32), 1
    bundles = bundled(bins) if k >= size else None
    sums = sums_yy = None  # of the nodes of this level, where they are kept
    wy = w * y
    wyy = wy * y
    for level in range(depth + 1):
        if sums is None:
            sw, sy, syy = (np.bincount(node, v, m) for v in (w, wy, wyy))
            if bundles and m <= NODES_AT_ONCE and level < depth:
                sums, sums_yy = _sums(bundles, rows, node, m, w, wy), syy
        here = _leaves(first, m)
        here["value"] = sy / np.maximum(sw, 1e-300)
        levels.append(here)
        if level == depth:
            break
        impurity = syy - sy ** 2 / np.maximum(sw, 1e-300)
        mixed = impurity > LEAST_GAIN * syy
        if not mixed.any():
            break
        best, feature, border = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64)
        if sums is not None:
            for f, (hw, hy) in enumerate(_by_bin(sums, bundles, size, wide)):
                gain, at = best_cut(hw, hy)
                more = gain > best
                best[more], feature[more], border[more] = gain[more], f, at[more]
        else:
            keep = np.flatnonzero(mixed[node])
            keep = keep[np.argsort(node[keep].astype(np.uint16 if m <= 1 << 16 else np.int32), kind="stable")]
            node, rows, w, wy, wyy = node[keep], rows[keep], w[keep], wy[keep], wyy[keep]
            starts = np.searchsorted(node, np.arange(m + 1))
            for low in range(0, m, NODES_AT_ONCE):
                drawn = _drawn_features(rng, min(NODES_AT_ONCE, m - low), size, k)
                for a, b in _runs(starts, low, low + len(drawn)):
                    i, j = starts[a], starts[b]
                    own, place, ws, wys = node[i:j] - a, rows[i:j].astype(np.int64) * size, w[i:j], wy[i:j]
                    base = own * np.int64(wide)
                    for f in drawn[a - low:b - low].T:
                        key = base + flat.take(place + f.take(own))
                        gain, at = best_cut(np.bincount(key, ws, (b - a) * wide).reshape(-1, wide), np.bincount(key, wys, (b - a) * wide).reshape(-1, wide))
                        more = gain > best[a:b]
                        best[a:b][more], feature[a:b][more], border[a:b][more] = gain[more], f[more], at[more]
        split = mixed & (best > LEAST_GAIN * impurity)
        if not split.any():
            break
        first += m
        number = np.cumsum(split) - 1
        here["feature"][split], here["bin"][split], here["child"][split] = feature[split], border[split], first + 2 * number[split]
        gains += np.bincount(feature[split], best[split], size)
        keep = split[node]
        if not keep.all():
            node, rows, w, wy, wyy = node[keep], rows[keep], w[keep], wy[keep], wyy[keep]
        child = np.empty(len(rows), np.int32)
        for a in range(0, len(rows), CACHED_ROWS):
            at, r = node[a:a + CACHED_ROWS], rows[a:a + CACHED_ROWS].astype(np.int64)
            child[a:a + CACHED_ROWS] = 2 * number[at] + (flat[r * size + feature[at]] > border[at])
        node = child
        m = 2 * int(split.sum())
        if sums is not None and m <= NODES_AT_ONCE and level + 1 < depth:
            pairs = np.bincount(node, minlength=m).reshape(-1, 2)
            sums, sums_yy = _below(sums, sums_yy, bundles, np.flatnonzero(split), pairs.argmin(1), rows, node, w, wy, wyy)
            codes = len(bundles[0][1])  # every row is in one code of the first bundle
            sw, sy, syy = sums[0, :, :codes].sum(1), sums[1, :, :codes].sum(1), sums_yy
        else:
            sums = None
    return np.concatenate(levels), gains


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter(self.instance).saveImpl(path)
        trees = pa.table({"tree": pa.array(range(len(self.instance.trees)), pa.int32()), "depth": pa.array([d for d, _ in self.instance.trees], pa.int32()),
                          "nodes": pa.array([b for _, b in self.instance.trees], pa.binary())})
        self.sparkSession.createDataFrame(trees).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        out = DefaultParamsReader(self.cls).load(path)
        out.trees = [(r["depth"], bytes(r["nodes"])) for r in self.sparkSession.read.parquet(f"{path}/trees").orderBy("tree").toLocalIterator()]
        return out


class HistogramForestModel(Model, _ForestParams, MLReadable, MLWritable):
    """Fitted trees: adds ``prediction`` and, for classes, ``probability``; batch and stream alike."""

    @keyword_only
    def __init__(self, featuresCol="features", classes=True, cuts="[]", importances=None):
        super().__init__()
        self.trees: list[tuple[int, bytes]] = []
        self._set(**self._input_kwargs | {"featuresCol": featuresCol, "classes": classes, "cuts": cuts, "importances": importances or []})

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    @property
    def featureImportances(self):
        return Vectors.dense(self.getOrDefault(self.importances))

    def _transform(self, df: DataFrame) -> DataFrame:
        cuts = [np.array(c, float) for c in json.loads(self.getOrDefault(self.cuts))]
        shared = df.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def mean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            trees = [(depth, np.frombuffer(zlib.decompress(nodes), NODE)) for depth, nodes in shared.value]
            trees = [(depth, {c: np.ascontiguousarray(t[c]) for c in NODE.names}) for depth, t in trees]
            for batch in batches:
                total = np.zeros(len(batch))
                if len(batch) and trees:
                    bins = to_bins(np.stack(batch.to_numpy()), cuts)
                    for depth, nodes in trees:
                        total += nodes["value"][reached(nodes, bins, depth)]
                yield pd.Series(total / max(len(trees), 1))

        value = mean(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))
        if not self.getOrDefault(self.classes):
            return df.withColumn("prediction", value)
        out = df.withColumn("_p1", value)
        return out.withColumn("probability", array_to_vector(F.array(1 - F.col("_p1"), F.col("_p1")))).withColumn(
            "prediction", (F.col("_p1") > 0.5).cast("double")).drop("_p1")


class HistogramForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Random forest; ``classes`` for 0/1 labels, else a regression."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", weightCol="", classes=True, numTrees=100, maxDepth=16, subsamplingRate=1.0,
                 sqrtFeatures=True, maxBins=32, seed=42):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", weightCol="", classes=True, numTrees=100, maxDepth=16, subsamplingRate=1.0,
                         sqrtFeatures=True, maxBins=32, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> HistogramForestModel:
        get = lambda name: self.getOrDefault(name)
        x, weight, trees, depth = vector_to_array(F.col(get("featuresCol"))), get("weightCol"), get("numTrees"), get("maxDepth")
        rows = df.select(x.alias("x"), _checked(F.col(get("labelCol")).cast("double"), "Labels", get("classes")).alias("y"),
                         (_checked(F.col(weight).cast("double"), "Weights") if weight else F.lit(1.0)).alias("w")).where("w > 0")
        first = rows.select(F.size("x").alias("n")).first()
        model = HistogramForestModel(featuresCol=get("featuresCol"), classes=get("classes"))
        if not first:
            raise ValueError("a forest needs rows of a positive weight")
        size = first["n"]
        cuts = feature_cuts(rows, F.col("x"), size, get("maxBins"))
        blocks = written(packed(rows, cuts, BLOCK_ROWS), "forest")
        n = blocks.agg(F.sum("n")).first()[0]
        share, seed = get("subsamplingRate"), get("seed")
        k = int(np.ceil(np.sqrt(size))) if get("sqrtFeatures") else size

        def drawn(block, rows, tree):
            """The rows of a tree among a block's ``rows``, and their counts."""
            counts = np.random.default_rng([seed, tree, block >> 32, block & 0xFFFFFFFF]).poisson(share, rows) if trees > 1 else np.ones(rows, int)
            at = np.flatnonzero(counts)
            return at, counts[at]

        tops = [_leaves(0, 1) for _ in range(trees)]
        depths, gains = [[0] for _ in range(trees)], np.zeros((trees, size))
        closed: set[tuple[int, int]] = set()
        large = [(t, 0) for t in range(trees)] if n * (1 - np.exp(-share)) > LOCAL_ROWS and depth else []
        while large:
            found = self._histograms(blocks, drawn, tops, depths, large, size, k)
            large = []
            for r in found:
                t, at = r["tree"], r["node"]
                if r["feature"] < 0:
                    tops[t]["value"][at] = r["value"]
                    closed.add((t, at))
                    continue
                child, below = len(tops[t]), depths[t][at] + 1
                tops[t] = np.concatenate([tops[t], _leaves(child, 2)])
                tops[t]["feature"][at], tops[t]["bin"][at], tops[t]["child"][at] = r["feature"], r["bin"], child
                depths[t] += [below, below]
                gains[t, r["feature"]] += r["gain"]
                large += [(t, child + side) for side, rows_ in enumerate((r["n_left"], r["n_right"])) if rows_ > LOCAL_ROWS and below < depth]
        self._subtrees(blocks, drawn, tops, depths, closed, gains, model, n, cuts, k)
        whole = gains.sum(1, keepdims=True)
        shares = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(0)
        return model._set(cuts=json.dumps(cuts), importances=(shares / shares.sum() if shares.sum() else shares).tolist())

    def _histograms(self, blocks: DataFrame, drawn, tops: list, depths: list, large: list, size: int, k: int) -> list:
        """The best split of each large node, or feature -1: one job, histograms of the drawn features summed by (tree, node)."""
        wide, seed, by_tree = self.getOrDefault("maxBins") + 2, self.getOrDefault("seed"), {}
        for t, at in large:
            by_tree.setdefault(t, []).append(at)
        tops = {t: tops[t] for t in by_tree}
        deep = {t: max(depths[t]) for t in by_tree}
        features = lambda t, at: _drawn_features(np.random.default_rng([seed, t, at]), 1, size, k)[0]

        def sums(batches):
            total = {}
            for batch in batches:
                for block, bins, y, w in unpacked(batch, size):
                    bundles = bundled(bins) if k >= size else None
                    for t, nodes in by_tree.items():
                        rows, counts = drawn(block, len(w), t)
                        weight = w[rows] * counts
                        slot = np.full(len(tops[t]), -1)
                        slot[nodes] = np.arange(len(nodes))
                        slot = slot[leaf_of(tops[t], bins, rows, deep[t])]
                        if len(tops[t]) > 1:
                            own = np.flatnonzero(slot >= 0)
                            slot, rows, weight = slot[own], rows[own], weight[own]
                        label = y[rows]
                        found = np.zeros((len(nodes), min(k, size), 4, wide))
                        if bundles:
                            for f, own in enumerate(_by_bin(_sums(bundles, rows, slot, len(nodes), weight, weight * label, None), bundles, size, wide)):
                                found[:, f, [0, 1, 3], :own.shape[2]] = own.transpose(1, 0, 2)
                        else:
                            of = np.array([features(t, at) for at in nodes])
                            for j in range(k):
                                key = slot * wide + bins[rows, of[slot, j]]
                                for i, v in ((0, weight), (1, weight * label), (3, None)):
                                    found[:, j, i] = np.bincount(key, v, len(nodes) * wide).reshape(-1, wide)
                        found[:, 0, 2, 0] = np.bincount(slot, weight * label ** 2, len(nodes))  # the node's, once
                        for at, add in zip(nodes, found, strict=True):
                            total[t, at] = total[t, at] + add if (t, at) in total else add
            part = TaskContext.get().partitionId()
            for (t, at), s in total.items():
                yield pa.RecordBatch.from_pydict({"tree": [t], "node": [at], "part": [part], "sums": [s.tobytes()]},
                                                 pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("part", pa.int64()), ("sums", pa.binary())]))

        def best(table: pa.Table) -> pa.Table:
            t, at = table["tree"][0].as_py(), table["node"][0].as_py()
            total = 0.0
            for _, s in sorted(zip(table["part"].to_pylist(), table["sums"].to_pylist(), strict=True)):
                total = total + np.frombuffer(s).reshape(-1, 4, wide)
            w, y, yy = (total[0, i].sum() for i in range(3))
            gain, cut = best_cut(total[:, 0], total[:, 1])
            f = int(gain.argmax())
            impurity = yy - y ** 2 / max(w, 1e-300)
            split = impurity > LEAST_GAIN * yy and gain[f] > LEAST_GAIN * impurity
            left = int(total[f, 3, :cut[f] + 1].sum())
            return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([at], pa.int32()),
                             "feature": pa.array([features(t, at)[f] if split else -1], pa.int32()), "bin": pa.array([cut[f]], pa.int32()), "gain": [float(gain[f])],
                             "value": [float(y / max(w, 1e-300))], "n_left": [left], "n_right": [int(total[f, 3].sum()) - left]})

        return blocks.mapInArrow(sums, HISTOGRAM).groupBy("tree", "node").applyInArrow(best, BEST).orderBy("tree", "node").collect()

    def _subtrees(self, blocks: DataFrame, drawn, tops: list, depths: list, closed: set, gains: np.ndarray, model, n: int, cuts: list, k: int) -> None:
        """Grow every open leaf of ``tops`` from its rows, one group for each, and set the model's trees: as many trees at a time as draw ``DEALT_ROWS`` rows."""
        depth = self.getOrDefault("maxDepth")
        leaves = [[at for at in np.flatnonzero(top["bin"] == 255).tolist() if top["child"][at] == at and (t, at) not in closed] for t, top in enumerate(tops)]
        share = 1 - np.exp(-self.getOrDefault("subsamplingRate")) if len(tops) > 1 else 1.0
        at_once = max(1, int(DEALT_ROWS / max(n * share, 1)))
        for low in range(0, len(tops), at_once):
            lot = range(low, min(low + at_once, len(tops)))
            got: dict[int, list] = {}
            for r in self._grown(blocks, drawn, {t: (tops[t], depths[t], leaves[t]) for t in lot}, n * share * len(lot), cuts, k).toLocalIterator():
                gains[r["tree"]] += np.frombuffer(r["gains"])
                got.setdefault(r["tree"], []).append((r["node"], bytes(r["nodes"])))
            for t in lot:
                top, own = tops[t], got.pop(t, [])
                if len(top) == 1 and own:
                    model.trees.append((depth, own[0][1]))
                    continue
                out, length = [top], len(top)
                for at, nodes in own:  # the root takes the leaf's place, the other nodes come behind
                    sub = np.frombuffer(zlib.decompress(nodes), NODE).copy()
                    sub["child"] += length - 1
                    if len(sub) == 1:
                        sub["child"][0] = at
                    top[at] = sub[0]
                    out.append(sub[1:])
                    length += len(sub) - 1
                model.trees.append((depth, zlib.compress(np.concatenate(out).tobytes(), 1)))

    def _grown(self, blocks: DataFrame, drawn, open_: dict, rows: float, cuts: list, k: int) -> DataFrame:
        """(tree, node, nodes, gains) of the subtrees at the leaves of ``open_``: {tree: (its top, the depth of each node, leaves)}."""
        groups, size = byte_groups(cuts), len(cuts)
        spark, seed, depth = blocks.sparkSession, self.getOrDefault("seed"), self.getOrDefault("maxDepth")
        schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("bins", "y", "w", "times", "weights"))])

        def deal(batches):
            for batch in batches:
                for block, bins, y, w in unpacked(batch, size):
                    codes, label, (values, weight) = folded(bins, groups), _narrow(y), _coded(w)
                    for t, (top, deep, nodes) in open_.items():
                        rows, counts = drawn(block, len(w), t)
                        leaf = leaf_of(top, bins, rows, max(deep))
                        order = np.argsort(leaf.astype(np.uint16 if len(top) < 1 << 16 else np.int64), kind="stable") if len(top) > 1 else slice(None)
                        leaf, rows, counts = leaf[order], rows[order], counts[order]
                        first, last = (np.searchsorted(leaf, nodes, side) for side in ("left", "right"))
                        for at, i, j in zip(nodes, first, last, strict=True):
                            if j > i:
                                own = rows[i:j]
                                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                                    (t, at, block, *(x.tobytes() for x in (codes[own], label[own], weight[own], _narrow(counts[i:j].astype(float)), values))),
                                    schema, strict=True)], schema=schema)

        def whole(table: pa.Table) -> pa.Table:
            t, at = table["tree"][0].as_py(), table["node"][0].as_py()
            order = np.argsort(table["block"].to_numpy())  # the sums of doubles do not depend on the shuffle
            col = lambda c: [table[c][int(i)].as_buffer() for i in order]
            codes = [np.frombuffer(x, np.uint8).reshape(-1, len(groups)) for x in col("bins")]
            wide = lambda c: [_widened(x, len(b)) for x, b in zip(col(c), codes, strict=True)]
            w = [np.frombuffer(v)[np.frombuffer(x, np.uint8)] if v.size else _widened(x, len(b)) for x, v, b in zip(col("w"), col("weights"), codes, strict=True)]
            w = np.concatenate(w) * np.concatenate(wide("times"))
            nodes, gain = grow(unfolded(np.concatenate(codes), groups, size), np.concatenate(wide("y")), w, k, depth - open_[t][1][at], np.random.default_rng([seed, t, at, 1]))
            return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([at], pa.int32()), "nodes": [zlib.compress(nodes.tobytes(), 1)],
                             "gains": [gain.tobytes()]})

        # more partitions than groups, so that few tasks take two
        parts = max(1, min(4 * sum(len(nodes) for _, _, nodes in open_.values()), max(8 * spark.sparkContext.defaultParallelism, int(rows * (size + 16) / 8e6))))
        grown = blocks.mapInArrow(deal, DRAWN).repartition(parts, "tree", "node").groupBy("tree", "node").applyInArrow(whole, GROWN)
        return written(grown, "forest-trees").orderBy("tree", "node")

"""Forests: distributed levels, subtrees, draws, saving, odd rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import forest as T
from tessera.operators import ml as M


def table(spark, n=900, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[:, 2] = rng.integers(0, 2, n)
    x[:, 3] = 5.0
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0)).astype(float)
    price = x[:, 0] * 3 + x[:, 2] * 10 + rng.normal(size=n)
    w = rng.integers(1, 4, n).astype(float)
    rows = [(i, *map(float, r), float(a), float(p), float(b)) for i, (r, a, p, b) in enumerate(zip(x, y, price, w, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double, price double, weight double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features", handleInvalid="keep").transform(df), x, y, price, w


def plain_tree(bins, y, w, depth):
    """Predictions of one tree over all features, one node at a time."""
    out = np.zeros(len(y))

    def down(rows, level):
        W, Y, YY = w[rows].sum(), (w * y)[rows].sum(), (w * y * y)[rows].sum()
        out[rows] = Y / W
        impurity, best = YY - Y * Y / W, (0.0, None)
        if level == depth or impurity <= 1e-9 * YY:
            return
        for f in range(bins.shape[1]):
            for b in range(bins[:, f].max()):
                left = rows[bins[rows, f] <= b]
                if 0 < len(left) < len(rows):
                    wl, yl = w[left].sum(), (w * y)[left].sum()
                    gain = yl * yl / wl + (Y - yl) ** 2 / (W - wl) - Y * Y / W
                    if gain > best[0] + 1e-9 * impurity:
                        best = (gain, left)
        if best[1] is not None:
            down(best[1], level + 1)
            down(np.setdiff1d(rows, best[1]), level + 1)

    down(np.arange(len(y)), 0)
    return out


@pytest.mark.parametrize("rows", [10 ** 9, 120])
def test_one_tree_equals_plain_numpy(spark, monkeypatch, rows):
    """One task alone, and histograms of the upper levels over several blocks before it."""
    df, x, _, price, w = table(spark)
    monkeypatch.setattr(T, "LOCAL_ROWS", rows)
    monkeypatch.setattr(T, "BLOCK_ROWS", 100)
    est = T.HistogramForest(labelCol="price", weightCol="weight", classes=False, numTrees=1, maxDepth=5, sqrtFeatures=False)
    model = est.fit(df.repartition(3))
    cuts = T.feature_cuts(df.select(T.vector_to_array("features").alias("x")), F.col("x"), 4, 32)
    assert cuts[2] == [0.5] and cuts[3] == []
    got = np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])
    assert np.abs(got - plain_tree(T.to_bins(x, [np.array(c) for c in cuts]), price, w, 5)).max() < 1e-9
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9 and model.featureImportances.toArray()[3] == 0


@pytest.mark.parametrize("rows", [10 ** 9, 150])
def test_forest_learns_and_saves(spark, monkeypatch, tmp_path, rows):
    """A forest without a depth limit is checkpointed with its scores, saved and loaded."""
    df, _, y, _, _ = table(spark)
    monkeypatch.setattr(T, "LOCAL_ROWS", rows)
    model = Pipeline(stages=[M.rf_classifier("label", "weight", trees=30, depth=M.NO_LIMIT, share=1.0)]).fit(df)
    p = lambda m: [r.p1 for r in M.positive_probability(m.transform(df)).select("id", "p1").checkpoint().orderBy("id").collect()]
    spark.sparkContext.setCheckpointDir(f"{tmp_path}/checkpoints")
    first = p(model)
    assert np.mean((np.array(first) > 0.5) == y) > 0.95 and 0 <= min(first) and max(first) <= 1
    assert first == p(M.save_load(model, f"{tmp_path}/model"))
    assert model.stages[0].featureImportances.toArray()[3] == 0


def test_forest_of_odd_rows(spark):
    df, *_ = table(spark, 60)
    one = M.rf_classifier("label", trees=3).fit(df.withColumn("label", F.lit(1)))
    assert {r.prediction for r in one.transform(df).collect()} == {1.0}
    assert M.rf_regressor("price", trees=3).fit(df).transform(df.limit(0)).count() == 0
    got = M.rf_classifier("label", "weight", trees=5).fit(df.withColumn("weight", F.when(F.col("id") < 10, 0.0).otherwise(1.0))).transform(df)
    assert got.where("prediction is null").count() == 0
    with pytest.raises(ValueError):
        M.rf_classifier("label", trees=3).fit(df.limit(0))
    for bad in (F.lit(None).cast("double"), F.lit(float("nan")), F.lit(2.0)):
        with pytest.raises(Exception, match="Labels MUST"):
            M.rf_classifier("label", trees=3).fit(df.withColumn("label", F.when(F.col("id") == 7, bad).otherwise(F.col("label"))))
    with pytest.raises(Exception, match="Weights MUST"):
        M.rf_classifier("label", "weight", trees=3).fit(df.withColumn("weight", F.when(F.col("id") != 7, 1.0)))


def test_only_smaller_children_are_summed_again(monkeypatch):
    """A node that takes all features gets its larger child's sums from its own; features of few values share a column."""
    rng = np.random.default_rng(3)
    kind = rng.integers(0, 4, 3000)
    bins = np.stack([rng.integers(0, 20, 3000), *(kind == i for i in range(4)), rng.integers(0, 9, 3000)], 1).astype(np.uint8)
    y, w = bins[:, 0] * (1.0 + bins[:, 2]) + rng.normal(size=3000), rng.integers(1, 4, 3000).astype(float)
    seen, sums = [], T._sums
    monkeypatch.setattr(T, "CACHED_ROWS", 256)
    monkeypatch.setattr(T, "_sums", lambda bundles, rows, *x: seen.append((len(rows), len(bundles))) or sums(bundles, rows, *x))
    nodes, gains = T.grow(bins, y, w, 6, 6, rng)
    assert len(seen) == 6 and seen[0][0] == 3000 and max(n for n, _ in seen[1:]) <= 1500 and max(b for _, b in seen) < 6
    assert np.abs(nodes["value"][T.reached(nodes, bins, 6)] - plain_tree(bins, y, w, 6)).max() < 1e-9 and gains[0] > 0


def test_folded_bins_and_narrow_numbers_come_back():
    rng = np.random.default_rng(5)
    cuts = [[0.0] * n for n in (1, 31, 0, 1, 2, 3, 32, 1, 1, 255, 4, 15, 16)]
    groups = T.byte_groups(cuts)
    bins = np.stack([rng.integers(0, len(c) + 1, 500) for c in cuts], 1).astype(np.uint8)
    assert len(groups) < len(cuts) and np.array_equal(T.unfolded(T.folded(bins, groups), groups, len(cuts)), bins)
    for x, size in (([1.0, 255.0], 1), ([300.0, 0.0], 2), ([70000.0, 0.5], 4), ([0.1, -1.0], 8), ([-1.0, 2.0], 4)):
        assert len(T._narrow(np.array(x)).tobytes()) == 2 * size and T._widened(T._narrow(np.array(x)).tobytes(), 2).tolist() == x


def test_trees_are_gathered_in_lots(spark, monkeypatch):
    """Lots of a few trees give the same forest; each lot is a write of its own."""
    df, *_ = table(spark, 300)
    df = df.withColumn("weight", F.when(F.col("label") > 0, 2.7).otherwise(0.3)).repartition(2).checkpoint()
    fit = lambda: M.rf_classifier("label", "weight", trees=7, depth=6, share=1.0).fit(df)
    whole, lots, written = fit(), [], T.written
    monkeypatch.setattr(T, "DEALT_ROWS", 500, raising=False)
    monkeypatch.setattr(T, "written", lambda rows, name: lots.append(name) or written(rows, name))
    cut = fit()
    assert lots.count("forest-trees") == 4 and whole.trees == cut.trees
    assert whole.featureImportances == cut.featureImportances


def test_weights_of_few_values_are_sent_as_bytes():
    for x, size in (([0.3, 2.7] * 100, 1), ([0.5] * 3, 1), (list(np.linspace(0.1, 1, 300)), 8)):
        values, places = T._coded(np.array(x))
        assert len(places.tobytes()) == size * len(x)
        assert (values[places] if len(values) else places).tolist() == x


def test_shuffle_files_go_with_the_write(spark):
    import time

    from tessera.session import SHUFFLE_CLEANUP, written
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {f for f in manager.getAllFiles().mkString(" ").split() if "shuffle_" in f}
    before = kept()
    got = written(spark.range(1000).repartition(5, "id"), "cleanup")
    for _ in range(50):
        if not (left := kept() - before):
            break
        time.sleep(0.1)
    assert not left and got.count() == 1000
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None

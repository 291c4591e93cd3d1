"""Model packages, scoring without a fit, stream restart, and histogram boosting against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import ml as M
from tessera.operators import packages as PK
from tessera.operators.boosting import HistogramBoostingClassifier, binned, cut_points
from tessera.plans import q_ml as Q
from tessera.plans.q_stream import valid_requests
from tessera.session import scratch_dir
from tessera.sources.tables import table_state
from tessera.streaming.scoring import score_frame, score_stream
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def package(spark):
    """A small published fraud model; scoring needs nothing else."""
    root = scratch_dir(spark, "packages")
    train, _ = Q.fraud_split(spark, SF_SMALL)
    model = M.fraud_pipeline(M.logistic("isFraud", train.count(), weight="weight")).fit(train)
    assert PK.publish(spark, root, "fraud", model, train, Q.FRAUD_INPUTS, 0.35, {"roc_auc": 0.5},
                      {"amount_threshold": model.stages[0].getOrDefault("amountThreshold")}) == 1
    return root, model


def test_package_round_trip_and_versions(spark, package):
    root, model = package
    got = PK.load(spark, root, "fraud")
    assert (got.version, got.threshold, got.metrics) == (1, 0.35, {"roc_auc": 0.5})
    assert [f.name for f in got.schema] == Q.FRAUD_INPUTS
    _, test = Q.fraud_split(spark, SF_SMALL)
    keys = Q.TXN_KEYS
    p = lambda m, name: M.positive_probability(m.transform(test)).select(*keys, F.col("p1").alias(name))
    worst = p(model, "a").join(p(got.model, "b"), keys).agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert worst < 1e-12
    assert PK.publish(spark, root, "fraud", model, test, Q.FRAUD_INPUTS, 0.5, None, {"amount_threshold": 1.0}) == 2
    assert PK.load(spark, root, "fraud").version == 2 and PK.load(spark, root, "fraud", 1).threshold == 0.35


def test_unfinished_version_is_not_seen(spark, package):
    root, model = package
    before = PK.versions(spark, root, "fraud")
    model.write().save(f"{root}/fraud/v000777/pipeline")  # a job that died before its manifest
    assert PK.versions(spark, root, "fraud") == before
    with pytest.raises(FileNotFoundError):
        PK.load(spark, root, "fraud", 777)
    with pytest.raises(FileNotFoundError):
        PK.load(spark, root, "nothing")


def test_mismatched_requests_are_refused(spark, package):
    got = PK.load(spark, package[0], "fraud", 1)
    req = valid_requests(spark, SF_SMALL)
    with pytest.raises(PK.SchemaMismatch, match="missing: amount"):
        score_frame(got, req.drop("amount"), Q.TXN_KEYS)
    with pytest.raises(PK.SchemaMismatch, match="Hour is string, not int"):
        score_frame(got, req.withColumn("Hour", F.col("Hour").cast("string")), Q.TXN_KEYS)
    assert score_frame(got, req.withColumn("more", F.lit(1)), Q.TXN_KEYS).count() == req.count()


def test_keys_score_without_a_fit(spark, monkeypatch):
    Q.fraud_package(spark, SF_SMALL, "logreg_balanced")
    monkeypatch.setattr(Q, "publish_fraud", lambda *a: pytest.fail("a published package was fitted again"))
    assert Q.fraud_scores(spark, SF_SMALL, "logreg_balanced").count() > 0


def test_stream_equals_batch_and_resumes(spark, package):
    """Files that arrive after a stop are scored once; the sink equals batch scoring (ST1, ST2)."""
    got = PK.load(spark, package[0], "fraud", 1)
    req = valid_requests(spark, SF_SMALL)
    half = F.pmod(F.hash(*Q.TXN_KEYS), F.lit(2)) == 0
    src, sink, ck = (scratch_dir(spark, x) for x in ("req", "out", "ck"))
    req.where(half).repartition(3).write.parquet(src)
    first = score_stream(spark, got, src, req.schema, sink, ck, Q.TXN_KEYS, bytes_per_trigger=1).count()
    assert first == req.where(half).count()
    req.where(~half).repartition(2).write.mode("append").parquet(src)
    streamed = score_stream(spark, got, src, req.schema, sink, ck, Q.TXN_KEYS)
    batch = score_frame(got, req, Q.TXN_KEYS).select(*streamed.columns)
    assert streamed.count() == req.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert score_stream(spark, got, src, req.schema, sink, ck, Q.TXN_KEYS).count() == req.count()  # nothing new: nothing again


def test_stream_that_dies_in_a_batch_goes_on(spark, package):
    """The first file is scored, the second kills the query; the next start finishes without loss or repeat."""
    got = PK.load(spark, package[0], "fraud", 1)
    req = valid_requests(spark, SF_SMALL)
    src, sink, ck, spare = (scratch_dir(spark, x) for x in ("req", "out", "ck", "spare"))
    req.limit(40).coalesce(1).write.parquet(src)
    score_stream(spark, got, src, req.schema, sink, ck, Q.TXN_KEYS)
    bad = req.limit(60).withColumn("amount", F.lit("x"))  # a file of another type fails the batch after its offsets were logged
    bad.coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception):
        score_stream(spark, got, src, req.schema, sink, ck, Q.TXN_KEYS)
    assert spark.read.parquet(sink).count() == 40
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    req.orderBy(*Q.TXN_KEYS).limit(60).coalesce(1).write.parquet(spare)
    written = lambda d: {str(s.getPath().getName()): s for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(d)) if str(s.getPath().getName()).startswith("part")}
    broken = max(written(src).values(), key=lambda s: s.getModificationTime()).getPath()
    repaired = next(iter(written(spare).values())).getPath()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert jvm.org.apache.hadoop.fs.FileUtil.copy(fs, repaired, fs, broken, False, True, conf)
    assert score_stream(spark, got, src, req.schema, sink, ck, Q.TXN_KEYS).count() == 100


def test_table_state_follows_the_files(spark):
    path = scratch_dir(spark, "state")
    spark.range(3).write.parquet(f"{path}/t.parquet")
    before = table_state(spark, path, ["t"])
    assert before == table_state(spark, path, ["t"])
    spark.range(3).write.mode("append").parquet(f"{path}/t.parquet")
    assert table_state(spark, path, ["t"]) != before


# ---------------------------------------------------------------- boosting
def plain_boosting(bins, missing, y, w, rounds, depth, step, l2, least):
    """Trees by recursion over row sets, one node at a time."""
    margin = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        add = np.zeros(len(y))

        def grow(rows, level):
            G, H = g[rows].sum(), h[rows].sum()
            best = (1e-6, None)
            for f in range(bins.shape[1]) if level < depth else ():
                lost = rows[bins[rows, f] == missing[f]]
                rest = rows[bins[rows, f] != missing[f]]
                for side in (False, True):
                    for b in range(missing[f]):
                        left = rest[bins[rest, f] <= b]
                        if side:
                            left = np.concatenate([left, lost])
                        gl, hl = g[left].sum(), h[left].sum()
                        if min(hl, H - hl) < least:
                            continue
                        gain = gl ** 2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G ** 2 / (H + l2)
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
            if best[1] is None:
                add[rows] = -step * G / (H + l2)
            else:
                grow(best[1], level + 1)
                grow(np.setdiff1d(rows, best[1]), level + 1)

        grow(np.arange(len(y)), 0)
        margin += add
    return 1 / (1 + np.exp(-margin))


def boosting_table(spark, n=240, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[:, 2] = rng.integers(0, 2, n)
    x[:, 3] = 5.0
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0)).astype(float)
    x[rng.random(n) < 0.2, 1] = np.nan
    w = rng.integers(1, 4, n).astype(float)
    rows = [(i, *map(float, r), float(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, w, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double, weight double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features", handleInvalid="keep").transform(df), y, w


def test_boosting_equals_plain_numpy(spark):
    df, y, w = boosting_table(spark)
    values = vector_to_array(F.col("features"))
    cuts = cut_points(df, values, 4, 8)
    assert cuts[3] == [5.0] and all(len(c) <= 7 for c in cuts)
    bins = np.array([r.bins for r in binned(df, values, cuts, [F.col("id")]).orderBy("id").collect()])
    want = plain_boosting(bins, [len(c) + 1 for c in cuts], y, w, 4, 3, 0.3, 1.0, 1.0)
    est = HistogramBoostingClassifier(weightCol="weight", maxIter=4, maxDepth=3, stepSize=0.3, maxBins=8)
    model = est.fit(df)
    got = np.array([r.p1 for r in M.positive_probability(model.transform(df)).orderBy("id").collect()])
    assert np.abs(got - want).max() < 1e-9
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9 and model.featureImportances.toArray()[3] == 0


def test_boosting_learns_saves_and_samples(spark, tmp_path):
    df, *_ = boosting_table(spark, 600, 5)
    df = df.withColumn("label", (F.col("a") + F.col("c") > 0.4).cast("int"))
    y = np.array([r.label for r in df.orderBy("id").collect()])
    est = HistogramBoostingClassifier(maxIter=12, maxDepth=3, stepSize=0.3, rowShare=0.8, columnShare=0.75, seed=1)
    model = Pipeline(stages=[est]).fit(df)
    p = lambda m: [r.p1 for r in M.positive_probability(m.transform(df)).orderBy("id").collect()]
    first = p(model)
    assert np.mean((np.array(first) >= 0.5) == y) > 0.8
    assert first == p(M.save_load(model, f"{tmp_path}/model"))
    again = Pipeline(stages=[est]).fit(df)  # seeded draws; sums of doubles may differ in their last digits
    assert max(abs(a - b) for a, b in zip(first, p(again), strict=True)) < 1e-6


def test_boosting_of_one_class_and_no_rows(spark):
    df, *_ = boosting_table(spark, 40)
    model = HistogramBoostingClassifier(maxIter=2, maxDepth=2).fit(df.withColumn("label", F.lit(1.0)))
    assert all(r.p1 > 0.5 for r in M.positive_probability(model.transform(df)).collect())
    empty = HistogramBoostingClassifier(maxIter=2).fit(df.limit(0))
    assert {r.p1 for r in M.positive_probability(empty.transform(df)).collect()} == {0.5}
    assert math.isclose(HistogramBoostingClassifier().getOrDefault("stepSize"), 0.1)


def test_scratch_tables_go_and_packages_stay(spark, monkeypatch):
    import uuid

    from tessera import session as S
    run = f"run-{uuid.uuid4().hex}"
    monkeypatch.setattr(S, "_run_dir", lambda spark: S.shared_dir(spark, run))
    path = S.scratch_dir(spark, "x")
    kept = S.shared_dir(spark, f"kept-{run}")
    spark.range(2).write.parquet(path)
    spark.range(2).write.parquet(kept)
    assert S.clear_scratch(spark) and not S.clear_scratch(spark)
    assert spark.read.parquet(kept).count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_boosting_runs_at_most_a_job_a_level(spark, monkeypatch):
    from tessera.operators import boosting as B
    df, *_ = boosting_table(spark, 600, 7)
    sc = spark.sparkContext

    def jobs(rounds):
        sc.setJobGroup(f"boosting-{rounds}", "")
        model = HistogramBoostingClassifier(maxIter=rounds, maxDepth=3, rowShare=0.9).fit(df)
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(f"boosting-{rounds}")), model

    (few, _), (more, model) = jobs(1), jobs(5)
    assert more - few <= 4 * 3
    monkeypatch.setattr(B, "MANY_TASKS", 0)  # sums added up on the executors
    monkeypatch.setattr(B, "BLOCK_ROWS", 10 ** 6)
    p = lambda m: np.array([r.p1 for r in M.positive_probability(m.transform(df)).orderBy("id").collect()])
    assert np.abs(p(jobs(5)[1]) - p(model)).max() < 1e-9


def test_rows_are_routed_by_a_table():
    """The table of a tree's splits sends each row as the splits do, missing values and closed nodes included."""
    from tessera.operators.boosting import _Tree
    rng, missing, n = np.random.default_rng(8), np.array([6, 3, 10]), 400
    bins = np.stack([rng.integers(0, m + 1, n) for m in missing]).astype(np.int16)
    tree = _Tree(4)
    for node in range(15):
        if (node == 0 or tree.feature[(node - 1) // 2] >= 0) and rng.random() < 0.8:
            f = int(rng.integers(0, 3))
            tree.feature[node], tree.bin[node], tree.missing_left[node] = f, rng.integers(0, missing[f]), rng.random() < 0.5
    table = tree._below(7, missing, 11)
    assert table.shape == (15, 11) and all((table[k] == k).all() for k in range(15) if k > 6 or tree.feature[k] < 0)
    for levels in range(5):
        want = []
        for i in range(n):
            node = 0
            for _ in range(levels):
                f = tree.feature[node]
                if f >= 0:
                    v = bins[f, i]
                    node = 2 * node + 1 + int(not tree.missing_left[node] if v == missing[f] else v > tree.bin[node])
            want.append(node)
        assert tree.reached(bins, levels, missing).tolist() == want

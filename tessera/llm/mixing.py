"""Mixing to target weights by soft membership.

A naive Bayes classifier is fitted on a bounded sample of labelled rows (words and word
endings; only those that mark ``low`` or ``toxic`` significantly and almost purely get a weight).  It gives every document posteriors over three domains: ``high`` and ``low``
quality and ``toxic``.  Nonnegative document rates are then fitted by projected gradient
least squares, so that the expected tokens of every domain match the targets.

With t the tokens and p the posteriors of a document, the domain totals are
``sum t * p * rate``.  The objective is the squared distance to the targets in the metric
of the Gram matrix ``G = sum t * p * p'``, whose gradient step is
``rate <- max(0, rate - p . G^-1 (totals - targets))`` with Lipschitz constant 1.  One
distributed sum gives each step; a document's rate is a fold over the few step vectors.

Defined cases: null or empty text has 0 tokens, the prior as posterior, and a rate like any
other; null ids stay; equal rows are separate rows; no labels: all documents are ``high``
and keep rate 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, stored
from tessera.sources.tables import table

DOMAINS = ("high", "low", "toxic")
#: Target shares of the tokens.  The total is the least at which no wanted domain is thinned out.
TARGETS = {"high": 0.8, "low": 0.2, "toxic": 0.0}
MAX_LABELLED = 20_000  # labelled rows that the classifier is fitted on
MAX_FEATURES = 4096
MIN_Z, MIN_PURITY, MAX_WEIGHT, MIN_PRIOR = 6.0, 0.9, 8.0, -6.0
END = "\x01"  # marks a word ending among the features
STEPS, TOLERANCE, MIN_GAIN = 25, 1e-4, 0.01


def _words(text: str = "text"):
    return F.filter(F.split(F.lower(F.col(text)), WHITE), lambda w: w != "")


def _features(rows: DataFrame) -> DataFrame:
    """``rows`` has an array ``words``; out comes one row per distinct word and per distinct word ending (its last two characters)."""
    known = rows.withColumn("words", F.array_distinct("words"))
    ends = F.array_distinct(F.transform("words", lambda w: F.concat(F.lit(END), F.right(w, F.lit(2)))))
    return known.withColumn("feature", F.explode_outer(F.concat("words", ends))).drop("words")


def fit_classifier(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, list[float]]:
    """Weights (feature, w_low, w_toxic) as log ratios against ``high``, and the two log prior ratios (among rows without a feature).

    The sample is the ``max_labelled`` labelled documents with the smallest id hash; equal
    texts of one label count once.  A feature counts once per document.  Endings count only
    without a letter or digit.  At most ``MAX_FEATURES`` features are kept, by significance.
    """
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    sample = (labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
              .select(F.col("doc_id").alias("id"), domain.alias("domain")).where("id is not null and domain is not null")
              .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    texts = (docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(sample), "id")
             .groupBy("domain", F.xxhash64("text").alias("text_hash")).agg(F.first(_words()).alias("words")))
    texts = stored(texts, "mix-sample")
    sizes = {r["domain"]: float(r["count"]) for r in texts.groupBy("domain").count().collect()}
    n = [sizes.get(k, 0.0) for k in range(3)]
    ending = F.col("feature").startswith(END)
    found = _features(texts.select("domain", "words")).where(F.col("feature").isNotNull() & (~ending | ~F.col("feature").rlike(r"[\p{L}\p{N}]")))
    counts = found.groupBy("feature").agg(*[F.sum((F.col("domain") == k).cast("double")).alias(f"n{k}") for k in range(3)])

    def z(k: int):
        expected = (F.col(f"n{k}") + F.col("n0")) * F.lit(n[k] / max(n[k] + n[0], 1.0))
        return (F.col(f"n{k}") - expected) / F.sqrt(expected + 1.0)

    def weight(k: int):
        ratio = F.log((F.col(f"n{k}") + 0.5) / F.lit(n[k] + 1.0)) - F.log((F.col("n0") + 0.5) / F.lit(n[0] + 1.0))
        tells = (z(k) >= MIN_Z) & (F.col(f"n{k}") >= MIN_PURITY * (F.col(f"n{k}") + F.col("n0")))
        return F.when(tells, F.least(F.lit(MAX_WEIGHT), ratio)).otherwise(0.0)

    weights = (counts.select("feature", weight(1).alias("w_low"), weight(2).alias("w_toxic"), F.greatest(z(1), z(2)).alias("z"))
               .where("w_low != 0 or w_toxic != 0").orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).drop("z"))
    weights = stored(weights, "mix-weights")
    seen = (_features(texts.select("text_hash", "domain", "words")).join(F.broadcast(weights), "feature", "left").groupBy("text_hash", "domain")
            .agg(*[F.coalesce(F.sum(f"w_{d}"), F.lit(0.0)).alias(d) for d in DOMAINS[1:]]).groupBy("domain")
            .agg(*[F.sum((F.col(d) == 0).cast("double")).alias(d) for d in DOMAINS[1:]]).collect())
    plain = {r["domain"]: r.asDict() for r in seen}
    silent = lambda k, d: plain.get(k, {}).get(d) or 0.0
    return weights, [max(MIN_PRIOR, float(np.log((silent(k, d) + 0.5) / (silent(0, d) + 0.5)))) if n[k] else MIN_PRIOR
                     for k, d in enumerate(DOMAINS[1:], 1)]


def posteriors(docs: DataFrame, weights: DataFrame, priors: list[float]) -> DataFrame:
    """(row, doc_id, text_hash, n_tokens, p_high, p_low, p_toxic) for every row of ``docs``.

    ``weights`` has at most ``MAX_FEATURES`` rows.  Features are summed per row before the shuffle.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"), _words().alias("words"))
    rows = rows.withColumn("n_tokens", F.greatest(F.coalesce(F.size("words"), F.lit(0)), F.lit(0)).cast("long"))
    sums = (_features(rows).join(F.broadcast(weights), "feature", "left").groupBy("row", "doc_id", "text_hash", "n_tokens")
            .agg(*[(F.coalesce(F.sum(f"w_{d}"), F.lit(0.0)) + F.lit(p)).alias(f"s_{d}") for d, p in zip(DOMAINS[1:], priors, strict=True)]))
    top = F.greatest(F.lit(0.0), "s_low", "s_toxic")
    parts = [F.exp(-top), F.exp(F.col("s_low") - top), F.exp(F.col("s_toxic") - top)]
    total = parts[0] + parts[1] + parts[2]
    return sums.select("row", "doc_id", "text_hash", "n_tokens", *[(x / total).alias(f"p_{d}") for d, x in zip(DOMAINS, parts, strict=True)])


def _rate(steps: list[np.ndarray]):
    """The rate after ``steps``: a fold over the step vectors."""
    if not steps:
        return F.lit(1.0)
    vectors = F.array(*[F.struct(*[F.lit(float(x)).alias(d) for d, x in zip(DOMAINS, s, strict=True)]) for s in steps])
    return F.aggregate(vectors, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - sum((F.col(f"p_{d}") * g[d] for d in DOMAINS), F.lit(0.0))))


def _totals(member: DataFrame, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens by domain, and the Gram matrix of the rows whose rate is above 0."""
    t = F.col("n_tokens").cast("double")
    free = F.when(F.col("rate") > 0, t).otherwise(0.0)
    row = member.withColumn("rate", _rate(steps)).agg(
        *[F.sum(t * F.col(f"p_{a}") * F.col("rate")).alias(a) for a in DOMAINS],
        *[F.sum(free * F.col(f"p_{a}") * F.col(f"p_{b}")).alias(f"{a}_{b}") for a in DOMAINS for b in DOMAINS]).first()
    return (np.array([row[a] or 0.0 for a in DOMAINS]), np.array([[row[f"{a}_{b}"] or 0.0 for b in DOMAINS] for a in DOMAINS]))


def fit_rates(member: DataFrame, targets: dict[str, float] = TARGETS):
    """The fitted rate as a column over the posteriors, and the expected totals and targets by domain.

    A step is scaled by the Gram matrix of the rows that are still above 0; where that does
    not lower the objective, the plain step (which always does) takes its place.
    """
    totals, gram = _totals(member, [])
    share = np.array([targets[a] for a in DOMAINS])
    goal = share * max([m / s for m, s in zip(totals, share, strict=True) if s > 0] + [0.0])
    inverse = lambda g: np.linalg.pinv(g, rcond=1e-9)
    metric = free = inverse(gram)
    lost = lambda x: float((x - goal) @ metric @ (x - goal))
    steps: list[np.ndarray] = []
    for _ in range(STEPS):
        if np.abs(totals - goal).max() <= TOLERANCE * max(goal.sum(), 1.0):
            break
        before = lost(totals)
        for way in (free, metric):
            now, gram = _totals(member, [*steps, step := way @ (totals - goal)])
            if lost(now) < before:
                break
        steps.append(step)
        totals, free = now, inverse(gram)
        if before - lost(now) <= MIN_GAIN * before:
            break
    return _rate(steps), dict(zip(DOMAINS, totals, strict=True)), dict(zip(DOMAINS, goal, strict=True))


def copies(rate, *key) -> F.Column:
    """Whole copies whose mean is the rate: the fraction is rounded up where the key's hash falls below it."""
    unit = F.pmod(F.xxhash64(*key, F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + F.lit(1e-6) + (F.lit(1.0 - 1e-6) - unit) * F.lit(1.0 - 1e-6)).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(row, doc_id, text_hash, n_tokens, p_*, rate, copies) of every row."""
    weights, priors = fit_classifier(docs, labels, max_labelled)
    member = stored(posteriors(docs, weights, priors), "mix-posteriors")
    rate, _, _ = fit_rates(member, targets)
    return member.withColumn("rate", rate).withColumn("copies", copies(F.col("rate"), "doc_id", "text_hash"))


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as its copies say, with the columns of ``docs``."""
    chosen = mixed.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("copies").alias("_n")).where("_n > 0").distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    same = rows["_id"].eqNullSafe(chosen["_id"]) & (rows["_hash"] == chosen["_hash"])
    kept = rows.join(chosen.hint("shuffle_hash"), same).select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    return kept.select("_row.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row", "text_hash")

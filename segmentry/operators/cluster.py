"""Mixture clustering of segment labels by their mean measures.

The facts are reduced to one row per label first. Labels are combinations of category lists, so everything
after `label_means` works on a table whose size does not depend on the facts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.session import cut, cut_clean


def label_means(facts: DataFrame, measures: Sequence[str] = ("CVR", "ATS", "1000_W_EFFICIENCY")) -> DataFrame:
    """Mean of every measure per label; NULL labels are left out, NULL values are skipped."""
    return (
        facts.filter(F.col("MASTER_LABEL").isNotNull()).groupBy("MASTER_LABEL")
        .agg(*[F.avg(f"`{m}`").alias(f"avg_{m}") for m in measures])
    )


@dataclass(frozen=True)
class Scaler:
    """Centre and spread per column, exact. A column without spread is only centred."""

    columns: tuple[str, ...]
    center: tuple[float, ...]
    spread: tuple[float, ...]

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str], kind: str = "robust") -> Scaler:
        def pair(name: str):
            c = F.col(f"`{name}`")
            if kind == "robust":
                return F.percentile(c, 0.5), F.percentile(c, 0.75) - F.percentile(c, 0.25)
            if kind == "standard":
                return F.avg(c), F.stddev_pop(c)
            if kind == "minmax":
                return F.min(c), F.max(c) - F.min(c)
            raise ValueError(f"unknown scaler: {kind}")

        parts = [part for name in columns for part in pair(name)]
        row = df.agg(*[part.alias(str(i)) for i, part in enumerate(parts)]).first()
        return Scaler(tuple(columns), tuple(row[0::2]), tuple(s or 1.0 for s in row[1::2]))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                name: (F.col(f"`{name}`") - F.lit(center)) / F.lit(spread)
                for name, center, spread in zip(self.columns, self.center, self.spread)
            }
        )


def scaled_features(means: DataFrame, kind: str = "robust") -> DataFrame:
    """Label, means and the scaled feature vector; labels with a missing mean cannot be clustered and are left out."""
    columns = [c for c in means.columns if c != "MASTER_LABEL"]
    complete = cut_clean(means.dropna(subset=columns).orderBy("MASTER_LABEL"))
    scaled = [f"scaled_{c}" for c in columns]
    renamed = complete.select("*", *[F.col(f"`{c}`").alias(s) for c, s in zip(columns, scaled)])
    table = Scaler.fit(renamed, scaled, kind).transform(renamed)
    return VectorAssembler(inputCols=scaled, outputCol="features").transform(table).drop(*scaled)


#: Added to every variance of a cluster, in squared units of the scaled features, so that each k can be scored.
RIDGE = 1e-6


def log_densities(x: np.ndarray, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> np.ndarray:
    """Log of weight times density, a row per point and a column per component."""
    found = np.empty((len(x), len(weights)))
    for j, (mean, covariance) in enumerate(zip(means, covariances)):
        root = np.linalg.cholesky(covariance)
        away = np.linalg.solve(root, (x - mean).T)
        scale = np.log(np.diag(root)).sum() + 0.5 * x.shape[1] * math.log(2 * math.pi)
        found[:, j] = math.log(weights[j]) - scale - 0.5 * (away * away).sum(0)
    return found


def _total(logs: np.ndarray) -> np.ndarray:
    top = logs.max(1, keepdims=True)
    return top[:, 0] + np.log(np.exp(logs - top).sum(1))


def _moments(x: np.ndarray, shares: np.ndarray, ridge: float):
    """Weights, means and covariances of points that belong to components by `shares`."""
    size = shares.sum(0) + 1e-14
    means = (shares.T @ x) / size[:, None]
    away = x[None] - means[:, None]
    covariances = np.einsum("nk,kni,knj->kij", shares, away, away) / size[:, None, None] + ridge * np.eye(x.shape[1])
    return size / size.sum(), means, covariances


def nearest_centres(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 50) -> np.ndarray:
    """k-means from centres drawn with probability by squared distance; the centre of each point."""
    centres = x[[rng.integers(len(x))]]
    while len(centres) < k:
        gap = ((x[:, None] - centres[None]) ** 2).sum(2).min(1)
        pick = rng.choice(len(x), p=gap / gap.sum()) if gap.sum() > 0 else rng.integers(len(x))
        centres = np.vstack([centres, x[pick]])
    own = None
    for _ in range(rounds):
        now = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        if own is not None and (now == own).all():
            break
        own = now
        centres = np.array([x[own == j].mean(0) if (own == j).any() else centres[j] for j in range(k)])
    return own


def _small_samples(x: np.ndarray, k: int, rng: np.random.Generator, ridge: float, size: int = 5):
    """Equal weights, and per component the mean and the variances of a few points: such starts find dense spots in wide groups."""
    drawn = x[rng.integers(len(x), size=(k, size))]
    covariances = np.array([np.diag(v + ridge) for v in drawn.var(1)])
    return np.full(k, 1 / k), drawn.mean(1), covariances


def grow_mixture(x: np.ndarray, k: int, seed: int, start: int, max_iter: int, tol: float, ridge: float) -> dict:
    """Expectation-maximisation until the log-likelihood gains less than `tol`.

    Even starts begin with the groups of k-means and their covariances, odd ones with a few points for each component.
    """
    rng = np.random.default_rng([seed, k, start])
    if start % 2:
        weights, means, covariances = _small_samples(x, k, rng, ridge)
    else:
        weights, means, covariances = _moments(x, np.eye(k)[nearest_centres(x, k, rng)], ridge)
    before, steps = -math.inf, 0
    while True:
        logs = log_densities(x, weights, means, covariances)
        total = _total(logs)
        if total.sum() - before < tol or steps == max_iter:
            break
        before, steps = total.sum(), steps + 1
        weights, means, covariances = _moments(x, np.exp(logs - total[:, None]), ridge)
    order = np.lexsort(means.T[::-1])  # components by mean, so that reruns number them alike
    return {
        "log_likelihood": float(total.sum()), "steps": steps, "weights": weights[order].tolist(),
        "means": means[order].tolist(), "covariances": covariances[order].tolist(),
    }


_MIXTURE = (
    "k int, start int, log_likelihood double, steps int, weights array<double>, means array<array<double>>, "
    "covariances array<array<array<double>>>"
)


def fit_mixtures(
    features: DataFrame, ks: Sequence[int], seed: int = 42, max_iter: int = 100, tol: float = 1e-3, ridge: float = RIDGE, starts: int = 20
) -> DataFrame:
    """The likeliest of `starts` seeded mixtures for every k: `k`, `start`, `log_likelihood`, `steps`, `weights`, `means`, `covariances`.

    Every pair of k and start is a task of its own over all labels. There are as many labels as combinations of category
    lists, whatever the facts.
    """

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.array(rows.sort_values(["MASTER_LABEL"], kind="stable")["x"].tolist())
        return pd.DataFrame([{"k": key[0], "start": key[1]} | grow_mixture(x, int(key[0]), seed, int(key[1]), max_iter, tol, ridge)])

    # Stated, so that small inputs are not put into one task.
    tasks = min(len(ks) * starts, 4 * features.sparkSession.sparkContext.defaultParallelism)
    pairs = F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("start")) for k in ks for i in range(starts)]))
    points = features.select("MASTER_LABEL", vector_to_array("features").alias("x"), pairs).repartition(tasks, "k", "start")
    tried = points.groupBy("k", "start").applyInPandas(fit, _MIXTURE)
    columns = [c.split()[0] for c in _MIXTURE.split(", ")]
    best = F.max_by(F.struct(*columns), F.struct("log_likelihood", -F.col("start"))).alias("best")
    return tried.groupBy("k").agg(best).select("best.*")


def bic(log_likelihood: float | Column, k: int | Column, dims: int, n: int) -> float | Column:
    free = k * dims + k * (dims * (dims + 1) / 2) + k - 1
    return free * math.log(n) - 2 * log_likelihood


def bic_sweep(
    features: DataFrame, ks: Sequence[int] = range(2, 11), seed: int = 42, max_iter: int = 100, ridge: float = RIDGE
) -> DataFrame:
    """Score of every number of clusters."""
    shape = features.select(F.count(F.lit(1)), F.max(F.size(vector_to_array("features")))).first()
    n, dims = shape[0], shape[1] or 0
    if not n:
        return features.sparkSession.createDataFrame([], "k int, bic double")
    fits = fit_mixtures(features, list(ks), seed, max_iter, ridge=ridge)
    return cut(fits.select("k", bic(F.col("log_likelihood"), F.col("k"), dims, n).alias("bic")))


def best_k(scores: DataFrame) -> int:
    row = scores.filter(F.col("bic").isNotNull()).agg(F.min_by("k", "bic").alias("k")).first()
    if row.k is None:
        raise ValueError("no number of clusters fits these labels")
    return row.k


def assign_clusters(
    features: DataFrame, k: int, seed: int = 42, max_iter: int = 100, ridge: float = RIDGE
) -> DataFrame:
    """The likeliest component of each label, as `GMM_CLUSTER`."""
    model = fit_mixtures(features, [k], seed, max_iter, ridge=ridge).first()  # k means and covariances
    if model is None:
        return features.withColumn("GMM_CLUSTER", F.lit(None).cast("int"))
    parts = [np.array(model[c]) for c in ("weights", "means", "covariances")]

    @F.pandas_udf("int")
    def likeliest(x: pd.Series) -> pd.Series:
        return pd.Series(log_densities(np.array(x.tolist()), *parts).argmax(1).astype("int32"))

    return cut(features.withColumn("GMM_CLUSTER", likeliest(vector_to_array("features"))))


def project_2d(features: DataFrame) -> DataFrame:
    """Centred two-dimensional projection. Each axis points to its largest loading, so reruns agree."""
    centred = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="centred")
    centred_table = centred.fit(features).transform(features)
    model = PCA(k=2, inputCol="centred", outputCol="projected").fit(centred_table)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(2)]
    axes = vector_to_array("projected")
    return model.transform(centred_table).select(
        *features.columns, (axes[0] * signs[0]).alias("PCA_x"), (axes[1] * signs[1]).alias("PCA_y")
    )


def attach_cluster(facts: DataFrame, clusters: DataFrame) -> DataFrame:
    """Cluster of every row by its label; rows without a label keep a NULL cluster."""
    return facts.join(clusters.select("MASTER_LABEL", "GMM_CLUSTER"), "MASTER_LABEL", "left").select(
        *facts.columns, "GMM_CLUSTER"
    )

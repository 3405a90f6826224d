"""Final analytics table to tests, labels, clusters, models and the best conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.config import FACTOR_LEVELS, FACTORS, MEASURES
from segmentry.operators.cluster import (
    assign_clusters, attach_cluster, best_k, bic_sweep, label_means, project_2d, scaled_features,
)
from segmentry.operators.group_tests import run_all_tests
from segmentry.operators.labels import attach_label, factor_decisions, kept_levels
from segmentry.operators.rank import master_table, scale_0_100, top_conditions
from segmentry.operators.regress import Fitted, Search, cell_statistics, fit_models, predict
from segmentry.session import cut, cut_clean
from segmentry.sources.readers import read_runs
from segmentry.sources.writers import log_rows, replace_runs


@dataclass
class Segments:
    tests: DataFrame
    levels: Mapping[str, Sequence[str]]
    bic: DataFrame
    labels: DataFrame
    facts: DataFrame
    fitted: Fitted
    best: DataFrame


_TEST_NUMBERS = ["p_value", "effect_size"]
_TEST_TEXTS = ["IV", "DV", "METHOD", "EFFECT_SIZE_TYPE", "JUDGEMENT", "JUDGEMENT_EFFECT_SIZE"]


def log_tests(tests: DataFrame, log: str) -> None:
    replace_runs(log_rows(tests, ["IV", "DV"], _TEST_NUMBERS, _TEST_TEXTS), log, "group_tests")


def tests_from_log(spark: SparkSession, log: str) -> DataFrame:
    """The test results as `run_all_tests` gives them."""
    by_run = read_runs(spark, log, "group_tests").groupBy("run")
    numbers = [F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in _TEST_NUMBERS]
    texts = [F.max(F.when(F.col("metric") == t, F.col("text"))).alias(t) for t in _TEST_TEXTS]
    return by_run.agg(*texts, *numbers).drop("run")


def log_fits(scores: DataFrame | None, fitted: Fitted, log: str) -> None:
    """Scores by number of clusters, trials of the search, and learning curves."""
    if scores is not None:
        replace_runs(log_rows(scores.withColumn("name", F.lit("mixture")), ["name"], ["bic"], step="k"), log, "mixture")
    trials = ["depth", "learning_rate", "trees", "val_rmse", "rmse_gap", "total_score"]
    replace_runs(log_rows(fitted.trials, ["GMM_CLUSTER", "measure"], trials, step="trial"), log, "trials")
    replace_runs(log_rows(fitted.curves, ["GMM_CLUSTER", "measure", "metric"], ["value"], step="step"), log, "curves")


def test_and_label(
    table: DataFrame, levels: Mapping[str, Sequence[str]] = FACTOR_LEVELS, strict_effect: bool = True, log: str | None = None
) -> tuple[DataFrame, dict[str, list[str]], DataFrame]:
    """Test results, kept factors, and the table with its segment label. With a run log the factors come from there."""
    tests = cut(run_all_tests(table, FACTORS, MEASURES))
    if log:
        log_tests(tests, log)
        tests = tests_from_log(table.sparkSession, log)
    kept = kept_levels(factor_decisions(tests, strict_effect=strict_effect), levels)
    return tests, kept, attach_label(table, kept)


def cluster_labels(
    labelled: DataFrame, k: int | None = None, scaler: str = "robust", max_iter: int = 100
) -> tuple[DataFrame | None, DataFrame]:
    """Scores by number of clusters (none if k is given) and the labels with cluster and projection."""
    features = scaled_features(label_means(labelled), scaler)
    scores = None if k is not None else bic_sweep(features, max_iter=max_iter)
    return scores, project_2d(assign_clusters(features, best_k(scores) if k is None else k, max_iter=max_iter))


def best_conditions(clustered: DataFrame, search: Search = Search(), n: int = 10) -> tuple[Fitted, DataFrame]:
    """Fitted models, and the master table of the best conditions per cluster and goal."""
    statistics = cut_clean(cell_statistics(clustered))
    fitted = fit_models(statistics.filter("n > 0"), search)
    return fitted, master_table(top_conditions(scale_0_100(predict(statistics, fitted)), n))


def run_segments(
    table: DataFrame, search: Search = Search(), strict_effect: bool = True, k: int | None = None, max_iter: int = 100,
    log: str | None = None,
) -> Segments:
    """The whole chain over a stored final table.

    Label and cluster are added on the fly, by arithmetic and a lookup, so no step rewrites the table; each
    reads the few columns it needs. `log` is the path of a run log for tests, mixture scores, trials and curves.
    """
    tests, kept, labelled = test_and_label(table, strict_effect=strict_effect, log=log)
    scores, labels = cluster_labels(labelled, k, max_iter=max_iter)
    clustered = attach_cluster(labelled, labels)
    fitted, best = best_conditions(clustered, search)
    if log:
        log_fits(scores, fitted, log)
    return Segments(tests, kept, scores, labels, clustered, fitted, best)

"""Scores of conditions and the best ones per cluster and goal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.config import CONDITION_COLUMNS, GOAL_LABELS, GOALS
from segmentry.functions.scalar import weighted_score
from segmentry.operators.ordering import top_per_group
from segmentry.session import cut


def distinct_conditions(
    facts: DataFrame, columns: Sequence[str] = CONDITION_COLUMNS, cluster: str = "GMM_CLUSTER"
) -> DataFrame:
    """Conditions that occur in each cluster; the media code becomes text. Rows without a cluster are left out."""
    return facts.filter(F.col(cluster).isNotNull()).select(
        cluster, *[F.col(c).cast("string").alias(c) for c in columns]
    ).distinct()


def scale_0_100(
    predictions: DataFrame, names: Sequence[str] = ("CVR", "EFF", "ATS"), cluster: str = "GMM_CLUSTER"
) -> DataFrame:
    """Min-max scale per cluster to 0..100; a constant column gives 0.

    The predictions are stored first, as they are read for the bounds and for the scaling. The bounds come
    from a partial aggregate and one small row per cluster, not from a window that would bring a whole cluster
    to one task.
    """
    predictions = cut(predictions)
    bounds = predictions.groupBy(cluster).agg(
        *[F.min(f"Pred_{n}").alias(f"_low_{n}") for n in names],
        *[F.max(f"Pred_{n}").alias(f"_high_{n}") for n in names],
    )
    scaled = {
        f"{n}_scaled": (F.col(f"Pred_{n}") - F.col(f"_low_{n}"))
        * (F.lit(100.0) / F.when(F.col(f"_high_{n}") == F.col(f"_low_{n}"), 1.0).otherwise(
            F.col(f"_high_{n}") - F.col(f"_low_{n}")
        ))
        for n in names
    }
    kept = [*predictions.columns, *scaled]
    return predictions.join(F.broadcast(bounds), cluster).withColumns(scaled).select(kept)


def score_goals(scaled: DataFrame, goals: Mapping[str, Mapping[str, float]] = GOALS) -> DataFrame:
    """One row per condition and goal with the weighted score."""
    scores = [F.struct(F.lit(g).alias("goal"), weighted_score(w).alias("score")) for g, w in goals.items()]
    return scaled.select("*", F.inline(F.array(*scores)))


def top_conditions(
    scaled: DataFrame,
    n: int = 10,
    goals: Mapping[str, Mapping[str, float]] = GOALS,
    columns: Sequence[str] = CONDITION_COLUMNS,
    cluster: str = "GMM_CLUSTER",
) -> DataFrame:
    """Best n conditions per cluster and goal; ties go by the condition columns."""
    order = [F.desc("score"), *[F.asc(c) for c in columns]]
    return top_per_group(score_goals(scaled, goals), [cluster, "goal"], order, n)


def goal_table(top: DataFrame, goal: str) -> DataFrame:
    return top.filter(F.col("goal") == goal).drop("goal")


def master_table(top: DataFrame, labels: Mapping[str, str] = GOAL_LABELS) -> DataFrame:
    """All goals in one table, with the report label of the goal."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return top.withColumn("Metric_Type", F.create_map(*pairs)[F.col("goal")]).drop("goal")

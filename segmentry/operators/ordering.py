"""Running totals, dense ids and duplicates without a one-task window.

A total order over all rows is cut at split points into many pieces. Each piece is sorted on its own, and
the totals of the pieces before it are added. Split points come from a hash sample of the distinct values, the same on
every run, or from a quantile sketch of the rows where values are numbers and some have far more rows than others. Either way
they are constants of the plan, so a lost executor changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segmentry.session import cut

_SAMPLE_PER_PIECE = 32


def split_points(df: DataFrame, column: str, pieces: int | None = None, is_distinct: bool = False) -> list:
    """At most `pieces - 1` values that cut the distinct values into pieces of similar size.

    By default there are as many pieces as shuffle partitions, so parallelism grows with the cluster.
    """
    if pieces is None:
        pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(f"`{column}`")
    values = df.select(value.alias("v")).dropna()
    values = values if is_distinct else values.distinct()
    sample = values.orderBy(F.xxhash64("v"), "v").limit(pieces * _SAMPLE_PER_PIECE)
    ordered = [row.v for row in sample.orderBy("v").collect()]  # bounded by the limit above
    step = len(ordered) / pieces
    return sorted({ordered[int(i * step)] for i in range(1, pieces)}) if ordered else []


def weighted_points(df: DataFrame, column: str, pieces: int | None = None) -> list[float]:
    """At most `pieces - 1` values of a numeric column that cut the rows, not the distinct values, into pieces of similar size.

    They come from one quantile sketch, merged before the shuffle and of a size that grows with `pieces` only. A value
    with more rows than a piece cannot be parted. The points differ a little from run to run; results do not depend on them.
    """
    if pieces is None:
        pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if pieces < 2:
        return []
    size = min(65_535, max(200, 64 * pieces))
    rows = df.select(F.col(f"`{column}`").cast("double").alias("v")).dropna()
    sketch = rows.agg(F.count("v").alias("n"), F.kll_sketch_agg_double("v", size).alias("sketch"))
    ranks = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    found = sketch.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("points")).first()
    return sorted(set(found.points or []))


def with_piece(df: DataFrame, column: str, points: Sequence, out: str) -> DataFrame:
    """Add the number of split points that are not above the value: binary search, one projection per halving."""
    value = F.col(f"`{column}`")
    df = df.withColumn(out, F.lit(0))
    if not points:
        return df
    table = F.array(*map(F.lit, points))
    step = 1 << (len(points).bit_length() - 1)
    while step:
        # Past the end of the points the comparison is NULL and the position stays.
        reached = F.get(table, F.col(out) + (step - 1)) <= value
        df = df.withColumn(out, F.when(reached, F.col(out) + step).otherwise(F.col(out)))
        step //= 2
    return df


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, weight: str, points: Sequence | None = None
) -> DataFrame:
    """Add `before` and `tied`: the weight of the rows of the same keys with a smaller, or the same, `order` value.

    Keys and `order` must not be NULL.
    """
    if points is None:
        points = split_points(df, order)
    pieces = with_piece(df, order, points, "_piece")
    by_piece = W.partitionBy(*keys).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(*keys, "_piece").agg(F.sum(weight).alias("_total"))
        .withColumn("_start", F.coalesce(F.sum("_total").over(by_piece), F.lit(0)))
        .drop("_total")
    )
    inside = W.partitionBy(*keys, "_piece").orderBy(order)
    return (
        pieces.join(starts, [*keys, "_piece"])
        .withColumns(
            {
                "tied": F.sum(weight).over(inside.rangeBetween(W.currentRow, W.currentRow)),
                "before": F.sum(weight).over(inside.rangeBetween(W.unboundedPreceding, W.currentRow)),
            }
        )
        .withColumn("before", F.col("_start") + F.col("before") - F.col("tied"))
        .drop("_piece", "_start")
    )


def dense_ids(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct non-NULL values of a column with ids 1..n in value order. The table is read once."""
    names = cut(df.select(column).dropna().distinct())
    points = split_points(names, column, is_distinct=True)
    ranked = running_total(names.withColumn("_one", F.lit(1).cast("long")), [], column, "_one", points)
    return ranked.select(column, (F.col("before") + 1).alias(out))


def batch_numbers(df: DataFrame, id_column: str, size: int = 100, out: str = "batch") -> DataFrame:
    return df.withColumn(out, F.floor((F.col(id_column) - 1) / size))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _keep(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _keep(df, keys, order, F.min_by)


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """One row per key by partial aggregation, so copies of a hot key are merged before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    # The remaining columns follow in the ordering, so rows that tie on `order` still give one answer.
    ranking = F.struct(*order, *[c for c in rest if c not in order])
    return df.groupBy(*keys).agg(pick(F.struct(*rest), ranking).alias("_row")).select(*keys, "_row.*").select(df.columns)


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "Rank"
) -> DataFrame:
    """Rank 1..n per group. Spark cuts each task's groups to n rows before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, rank).filter(F.col(out) <= n)

"""One boosted regression per cluster and measure on three categorical columns.

The facts are reduced to one weighted row per condition, cluster and split; squared loss has the same minimum on these
rows. Categories, and their pairs and triples, become target statistics. A training row gets its statistics from the
rows before it in a hash order, so that its own value does not leak into its features; all other rows get those of
all training rows.

Every pair of model and trial is a task of its own: symmetric trees are grown one by one on the binned statistics until
the validation error has not improved for `patience` trees, so no tree is grown twice. The cells of the model, whose number
grows with the media, lie in files of the task's own temp folder and are gone through in parts, so its memory does not grow.
"""

from __future__ import annotations

import itertools
import math
import random
import tempfile
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from segmentry.config import CONDITION_COLUMNS, MEASURES, PREDICTION_NAMES
from segmentry.functions.scalar import holdout
from segmentry.operators.rank import distinct_conditions
from segmentry.session import cut, cut_clean, fresh_path, settings, work_folder

MODEL = ["GMM_CLUSTER", "measure"]
ROW_KEYS = ["KEY", "MDA", "DATE", "TIME"]
#: Conditions that a task predicts at a time, and those that are joined with their means at a time.
PART_ROWS = 100_000
SLICE_ROWS = 1_000_000
#: Rows that a training task goes through at a time, and bytes from which it keeps a column in a file.
CHUNK_ROWS = 1 << 17
FILE_BYTES = 4 << 20


def cell_statistics(
    facts: DataFrame,
    conditions: Sequence[str] = CONDITION_COLUMNS,
    measures: Sequence[str] = MEASURES,
    is_holdout: Column | None = None,
) -> DataFrame:
    """Per cluster, measure, condition and split: rows, mean, sum of squares around it, smallest and largest value.

    Every condition that occurs has rows here, also where a measure has no value (`n` is 0). One in five rows is
    held out, by default chosen by a hash of the row's keys.
    """
    if is_holdout is None:
        is_holdout = holdout([F.col(c) for c in ROW_KEYS if c in facts.columns])
    keys = ["GMM_CLUSTER", *conditions, "is_holdout"]
    rows = facts.filter(F.col("GMM_CLUSTER").isNotNull()).select(
        "GMM_CLUSTER", *[F.col(c).cast("string").alias(c) for c in conditions],
        is_holdout.alias("is_holdout"), *[F.col(f"`{m}`").cast("double").alias(m) for m in measures],
    )
    statistics = []
    for m in measures:
        y = F.col(f"`{m}`")
        statistics.append(
            F.struct(
                F.lit(m).alias("measure"), F.count(y).alias("n"), F.avg(y).alias("y"),
                (F.var_pop(y) * F.count(y)).alias("ss"), F.min(y).alias("low"), F.max(y).alias("high"),
            ).alias(f"_{m}")
        )
    cells = rows.groupBy(*keys).agg(*statistics)
    return cells.select(*keys, F.inline(F.array(*[F.col(f"`_{m}`") for m in measures])))


def condition_cells(facts: DataFrame, *args, **options) -> DataFrame:
    """The cells of `cell_statistics` that have a value."""
    return cell_statistics(facts, *args, **options).filter(F.col("n") > 0)


def constant_models(cells: DataFrame) -> DataFrame:
    """(cluster, measure) whose training rows hold one value only, with that value."""
    train = F.when(~F.col("is_holdout"), F.col("low")), F.when(~F.col("is_holdout"), F.col("high"))
    return (
        cells.groupBy(*MODEL)
        .agg(F.min(train[0]).alias("low"), F.max(train[1]).alias("high"), F.min("low").alias("any"))
        .filter(F.col("low").isNull() | (F.col("low") == F.col("high")))
        .select(*MODEL, F.coalesce("low", "any").alias("value"))
    )


def combinations(conditions: Sequence[str], combine: int) -> list[tuple[str, ...]]:
    """The columns alone, then their pairs, and so on up to `combine` columns together."""
    return [c for size in range(1, combine + 1) for c in itertools.combinations(conditions, size)]


def _category(columns: Sequence[str]) -> Column:
    """One text for the values of the columns, NULL if one of them is."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return F.when(known, F.concat_ws("\x1f", *columns))


def overall_means(cells: DataFrame) -> DataFrame:
    """(cluster, measure) -> `prior`, the mean of the training rows."""
    train = cells.filter(~F.col("is_holdout"))
    return train.groupBy(*MODEL).agg((F.sum(F.col("n") * F.col("y")) / F.sum("n")).alias("prior"))


def category_means(cells: DataFrame, prior: DataFrame, columns: Sequence[str], smoothing: float = 1.0) -> DataFrame:
    """The rows of `target_means` for one combination of columns."""
    train = cells.filter(~F.col("is_holdout")).withColumn("category", _category(columns))
    return (
        train.filter(F.col("category").isNotNull()).groupBy(*MODEL, "category")
        .agg(F.sum(F.col("n") * F.col("y")).alias("total"), F.sum("n").alias("rows"))
        .join(F.broadcast(prior), MODEL)  # one row per cluster and measure
        .select(
            *MODEL, F.lit("+".join(columns)).alias("column"), "category",
            ((F.col("total") + smoothing * F.col("prior")) / (F.col("rows") + smoothing)).alias("encoded"),
        )
    )


def _unknown_means(prior: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return prior.select(*MODEL, nothing.alias("column"), nothing.alias("category"), F.col("prior").alias("encoded"))


def target_means(
    cells: DataFrame, conditions: Sequence[str] = CONDITION_COLUMNS, smoothing: float = 1.0, combine: int = 1
) -> DataFrame:
    """(cluster, measure, column, category) -> mean of the training rows, pulled to the overall mean by `smoothing` rows.

    The row with a NULL category holds the overall mean, for categories not seen in training. With `combine` there are also rows
    for up to so many columns together, named `A+B`.
    """
    prior = overall_means(cells)
    by_category = [category_means(cells, prior, c, smoothing) for c in combinations(conditions, combine)]
    return reduce(DataFrame.unionByName, [*by_category, _unknown_means(prior)])


def encode(rows: DataFrame, means: DataFrame, conditions: Sequence[str] = CONDITION_COLUMNS) -> DataFrame:
    """Add the feature vector of target means to rows that have cluster, measure and the condition columns."""
    prior = means.filter(F.col("column").isNull()).select(*MODEL, F.col("encoded").alias("_prior"))
    table = rows.join(prior, MODEL)
    for c in conditions:
        known = means.filter(F.col("column") == c).select(
            *MODEL, F.col("category").alias(c), F.col("encoded").alias(f"_{c}")
        )
        table = table.join(known, [*MODEL, c], "left").withColumn(f"_{c}", F.coalesce(f"_{c}", "_prior"))
    assembled = VectorAssembler(inputCols=[f"_{c}" for c in conditions], outputCol="features").transform(table)
    return assembled.select(*rows.columns, "features")


def full_statistics(
    asked: DataFrame, means: DataFrame, conditions: Sequence[str] = CONDITION_COLUMNS, combine: int = 3,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Distinct conditions (cluster, condition columns) with an array of features per measure, `_0`, `_1`, ...: the means of all
    training rows.

    The measures share one row, and every combination of columns is joined on its own, so no row is multiplied. The table of means
    grows with the facts while its files stay small; the hint keeps it out of a broadcast.
    """
    def by_measure(value: Column, name: str) -> list[Column]:
        return [F.max(F.when(F.col("measure") == m, value)).alias(f"{name}_{i}") for i, m in enumerate(measures)]

    means = means.filter(F.col("measure").isin(list(measures)))
    means = means.withColumn("encoded", F.col("encoded").cast("float"))  # as `_matrix` does
    known = means.filter(F.col("column").isNotNull()).groupBy("GMM_CLUSTER", "column", "category").agg(*by_measure(F.col("encoded"), "_f"))
    known = cut_clean(known, ["column"])
    prior = means.filter(F.col("column").isNull()).groupBy("GMM_CLUSTER").agg(*by_measure(F.col("encoded"), "_p"))
    rows = asked.select("GMM_CLUSTER", *conditions)
    names = sorted(("+".join(c), c) for c in combinations(conditions, combine))
    for j, (name, columns) in enumerate(names):
        one = known.filter(F.col("column") == name).select(
            "GMM_CLUSTER", F.col("category").alias("_category"), *[F.col(f"_f_{i}").alias(f"_f{j}_{i}") for i in range(len(measures))]
        )
        rows = rows.withColumn("_category", _category(columns)).join(one.hint("merge"), ["GMM_CLUSTER", "_category"], "left").drop("_category")
    rows = rows.join(F.broadcast(prior), "GMM_CLUSTER", "left")  # one row per cluster
    features = [
        F.array(*[F.coalesce(f"_f{j}_{i}", f"_p_{i}") for j in range(len(names))]).alias(f"_{i}") for i in range(len(measures))
    ]
    return rows.select("GMM_CLUSTER", *conditions, *features)


def cell_features(
    cells: DataFrame, conditions: Sequence[str] = CONDITION_COLUMNS, smoothing: float = 1.0, combine: int = 3
) -> DataFrame:
    """The cells with `features`, one statistic per combination of columns, in the order of the combinations' names.

    A training cell gets the mean of the training rows of the same category that come before it in the order of a hash of its
    conditions, a held-out cell that of all training rows: both are running sums, in which held-out cells come last and count
    nothing. The overall mean pulls by `smoothing` rows.
    """
    measures = _measures(cells)
    pieces = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = wide_features(cells, measures, conditions, smoothing, combine, pieces)
    one = [F.struct(F.lit(m).alias("measure"), f"_{i}.*", F.col(f"_x{i}").alias("features")) for i, m in enumerate(measures)]
    return wide.select("GMM_CLUSTER", *conditions, "is_holdout", F.inline(F.array(*one))).filter(F.col("n").isNotNull())


def _measures(cells: DataFrame) -> list[str]:
    return sorted(r.measure for r in cells.select("measure").distinct().collect())  # a list of the configuration


def wide_features(
    cells: DataFrame, measures: Sequence[str], conditions: Sequence[str], smoothing: float, combine: int, pieces: int, kind: str = "double"
) -> DataFrame:
    """`cell_features` with one row for all measures: `_0` (n, y, ss) and its features `_x0`, `_1` and so on, and `_place`, the
    hash of the conditions.

    Combinations with the column of most values are summed where its categories lie together; the others have few and large
    categories, so their order is cut into pieces, and the totals of the pieces before come as rows of their own at the begin of
    a piece. The rows are dealt out twice; `kind` is the type of the features.
    """
    n_values = cells.agg(*[F.approx_count_distinct(c).alias(c) for c in conditions]).first()
    widest = max(conditions, key=lambda c: n_values[c])
    every = range(len(measures))

    keys = ["GMM_CLUSTER", *conditions, "is_holdout"]
    place = F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in conditions]).cast("binary"))
    wide = (
        cells.repartition("GMM_CLUSTER", widest).groupBy(*keys)
        .agg(*[F.max(F.when(F.col("measure") == m, F.struct("n", "y", "ss"))).alias(f"_{i}") for i, m in enumerate(measures)])
        .withColumn("_place", F.conv(F.substring(place, 1, 15), 16, 10).cast("long"))  # 60 bits of the hash
    )
    train = cells.filter(~F.col("is_holdout"))
    means = [F.sum(F.when(F.col("measure") == m, F.col("n") * F.col("y"))) / F.sum(F.when(F.col("measure") == m, F.col("n"))) for m in measures]
    prior = cut(train.groupBy("GMM_CLUSTER").agg(*[mean.alias(f"_p{i}") for i, mean in enumerate(means)]))
    sums = [f"_{sum_of}{i}" for sum_of in "tn" for i in every]
    names = sorted(("+".join(c), c) for c in combinations(conditions, combine))

    def with_sums(rows: DataFrame) -> DataFrame:
        counted = {f"_t{i}": F.col(f"_{i}.n") * F.col(f"_{i}.y") for i in every} | {f"_n{i}": F.col(f"_{i}.n") for i in every}
        rows = rows.withColumns({s: F.when(~F.col("is_holdout"), value) for s, value in counted.items()})
        return rows.join(F.broadcast(prior), "GMM_CLUSTER", "left")  # one row per cluster

    def encoded(columns: Sequence[str], so_far) -> dict[str, Column]:
        known = _category(columns).isNotNull()

        def before(s: str) -> Column:
            return F.coalesce(so_far(s), F.lit(0.0))

        return {
            f"{'+'.join(columns)}_{i}": F.when(known, (before(f"_t{i}") + smoothing * F.col(f"_p{i}")) / (before(f"_n{i}") + smoothing))
            .otherwise(F.col(f"_p{i}")).cast(kind) for i in every
        }

    table = with_sums(wide)
    for _, columns in names:
        if widest in columns:
            earlier = W.partitionBy("GMM_CLUSTER", *columns).orderBy("is_holdout", "_place", *conditions).rowsBetween(W.unboundedPreceding, -1)
            table = table.withColumns(encoded(columns, lambda s: F.sum(s).over(earlier)))
    rest = [c for _, c in names if widest not in c]
    if rest:
        # Held-out cells have pieces of their own behind those of the training cells.
        piece = F.shiftright(F.col("_place"), 30) * pieces
        table = table.withColumn("_piece", F.shiftright(piece, 30) + F.when(F.col("is_holdout"), pieces).otherwise(0))
        wide = with_sums(cut_clean(table.drop(*sums, *[f"_p{i}" for i in every])))
        table = wide.withColumn("_start", F.lit(None).cast("int"))
        for j, columns in enumerate(rest):
            by = ["GMM_CLUSTER", *columns]
            ahead = W.partitionBy(*by).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
            totals = wide.groupBy(*by, "_piece").agg(*[F.sum(s).alias(f"{s}_total") for s in sums])
            starts = totals.select(
                *by, "_piece", F.lit(j).alias("_start"), F.lit(-1).cast("long").alias("_place"),
                *[F.sum(f"{s}_total").over(ahead).alias(s) for s in sums],
            )
            table = table.unionByName(starts, allowMissingColumns=True)
        table = table.repartition("GMM_CLUSTER", "_piece")
        for j, columns in enumerate(rest):
            inside = W.partitionBy("GMM_CLUSTER", "_piece", *columns).orderBy("_place", *conditions).rowsBetween(W.unboundedPreceding, -1)
            counts = F.col("_start").isNull() | (F.col("_start") == j)
            table = table.withColumns(encoded(columns, lambda s: F.sum(F.when(counts, F.col(s))).over(inside)))
        table = table.filter(F.col("_start").isNull())
    features = [F.array(*[F.col(f"`{name}_{i}`") for name, _ in names]).alias(f"_x{i}") for i in every]
    return table.select(*keys, "_place", *[f"_{i}" for i in every], *features)


def ordered_means(
    cells: DataFrame, conditions: Sequence[str] = CONDITION_COLUMNS, smoothing: float = 1.0, combine: int = 3
) -> DataFrame:
    """Per training cell and combination of columns: `encoded`, the mean of the training rows of the same category that come
    before the cell in the order of a hash of its conditions, pulled to the overall mean by `smoothing` rows."""
    features = cell_features(cells.filter(~F.col("is_holdout")), conditions, smoothing, combine)
    names = sorted("+".join(c) for c in combinations(conditions, combine))
    one = [F.struct(F.lit(name).alias("column"), F.col("features")[i].alias("encoded")) for i, name in enumerate(names)]
    return features.select(*MODEL, *conditions, F.inline(F.array(*one)))


@dataclass(frozen=True)
class Search:
    """Settings of the search: `trials` random pairs of depth and learning rate, each with early stopping.

    A model grows until its validation error has not improved for `patience` trees, or to `max_iter` trees. `bins` is the
    number of steps of a feature that trees can split at, `l2` the weight, in rows, that pulls leaves to zero.
    """

    trials: int = 5
    max_iter: int = 1500
    patience: int = 100
    depth: tuple[int, int] = (4, 8)
    rate: tuple[float, float] = (0.005, 0.05)
    gap_weight: float = 0.7
    seed: int = 42
    bins: int = 32
    l2: float = 3.0

    def candidates(self, cluster: int, measure: str) -> list[tuple[int, float]]:
        rng = random.Random(f"{self.seed}/{cluster}/{measure}")
        low, high = map(math.log, self.rate)
        return [(rng.randint(*self.depth), math.exp(rng.uniform(low, high))) for _ in range(self.trials)]


def scratch(shape: int | tuple[int, ...], kind) -> np.ndarray:
    """An array for a task. A large one lies in a file of its temp folder, which goes with the array."""
    if int(np.prod(shape)) * np.dtype(kind).itemsize < FILE_BYTES:
        return np.empty(shape, kind)
    with tempfile.TemporaryFile() as file:
        return np.asarray(np.memmap(file, kind, "w+", shape=shape))


def chunks(rows: int | slice) -> Iterator[slice]:
    first, last = (rows.start, rows.stop) if isinstance(rows, slice) else (0, rows)
    for at in range(first, last, CHUNK_ROWS):
        yield slice(at, min(at + CHUNK_ROWS, last))


def borders(values: np.ndarray, bins: int) -> np.ndarray:
    """At most `bins - 1` values between the distinct ones. Sorts the values in place."""
    values.sort()

    def new_values() -> Iterator[np.ndarray]:
        last = None
        for part in chunks(len(values)):
            found = np.unique(values[part])
            found = found[1:] if last is not None and len(found) and found[0] == last else found
            if len(found):
                last = found[-1]
                yield found

    gaps = sum(map(len, new_values())) - 1
    picked = np.linspace(0, gaps - 1, bins - 1).round().astype(int) if gaps >= bins else np.arange(max(gaps, 0))
    wanted, found, first = np.unique(np.concatenate([picked, picked + 1])), [], 0
    for part in new_values():
        here = wanted[(wanted >= first) & (wanted < first + len(part))]
        found.append(part[here - first].astype(float))
        first += len(part)
    at = np.concatenate([*found, np.empty(0)])
    return (at[np.searchsorted(wanted, picked + 1)] + at[np.searchsorted(wanted, picked)]) / 2


def binned(features: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Number of borders below each value, a row per feature."""
    return np.array([np.searchsorted(e, features[:, i]) for i, e in enumerate(edges)], np.int16).reshape(len(edges), -1)


@dataclass
class Side:
    """Training or held-out cells: features and later their bins (a row per feature), means, rows and predictions."""

    features: np.ndarray
    y: np.ndarray
    n: np.ndarray
    at: np.ndarray

    def __post_init__(self) -> None:
        self.rows = 0.0

    @staticmethod
    def of(features: np.ndarray, y: np.ndarray, n: np.ndarray, held: np.ndarray, is_held: bool, spans: Sequence[slice]) -> Side:
        rows = sum(int((held[part] == is_held).sum()) for part in chunks(len(y)))
        side = Side(scratch((features.shape[1], rows), features.dtype), *(scratch(rows, float) for _ in range(3)))
        last = 0
        for part in itertools.chain.from_iterable(map(chunks, spans)):
            own = held[part] == is_held
            to = slice(last, last := last + int(own.sum()))
            side.features[:, to], side.y[to], side.n[to] = features[part][own].T, y[part][own], n[part][own]
        return side

    def average(self, value) -> float:
        """Mean of a value of each part, weighted by rows."""
        self.rows = self.rows or sum(self.n[part].sum() for part in chunks(len(self.y)))
        return float(sum((value(part) * self.n[part]).sum() for part in chunks(len(self.y))) / self.rows)

    def put_into_bins(self, edges: Sequence[np.ndarray]) -> None:
        bins = scratch(self.features.shape, np.min_scalar_type(max(map(len, edges), default=0)))
        for i, e in enumerate(edges):
            for part in chunks(len(self.y)):
                bins[i, part] = np.searchsorted(e, self.features[i, part])
        self.features = bins

    def error(self, inside: float) -> float:
        return math.sqrt(self.average(lambda part: (self.y[part] - self.at[part]) ** 2) + inside)


def grow_tree(side: Side, used: Sequence[int], leaf: np.ndarray, depth: int, n_bins: int, l2: float):
    """A symmetric tree, one split (feature, border) per level for all leaves, that fits the residuals.

    Only the `used` features are tried; without any there is nothing to split. Returns the splits, and by leaf the sums of
    residuals and of rows; `leaf` takes the leaf of each cell.
    """
    bins, k, splits = side.features, len(used), []
    leaf[:] = 0
    for level in range(depth + 1):
        shape = (1 << level, k, n_bins)
        weight, total = np.zeros(shape), np.zeros(shape)
        sums = np.zeros((2, 1 << depth))
        for part in chunks(len(side.y)):
            own = leaf[part].astype(np.intp)
            if level:
                feature, border = splits[-1]
                own = 2 * own + (bins[feature, part] > border)
                leaf[part] = own
            n = side.n[part]
            pull = n * (side.y[part] - side.at[part])
            if level == depth:
                sums += np.bincount(own, pull, 1 << depth), np.bincount(own, n, 1 << depth)
                continue
            base = own * n_bins
            for place, feature in enumerate(used):
                at = base + bins[feature, part]
                weight[:, place] += np.bincount(at, n, shape[0] * n_bins).reshape(-1, n_bins)
                total[:, place] += np.bincount(at, pull, shape[0] * n_bins).reshape(-1, n_bins)
        if level == depth:
            return splits, sums
        if not used:
            splits.append((0, n_bins))
            continue
        weight, total = weight.cumsum(2), total.cumsum(2)
        left, right = total[..., :-1], total[..., -1:] - total[..., :-1]
        gain = left * left / (weight[..., :-1] + l2) + right * right / (weight[..., -1:] - weight[..., :-1] + l2)
        place, border = divmod(int(gain.sum(0).argmax()), n_bins - 1)
        splits.append((used[place], border))


def leaves_of(bins: np.ndarray, splits: Sequence[tuple[int, int]]) -> np.ndarray:
    leaf = np.zeros(bins.shape[1], np.int64)
    for feature, border in splits:
        leaf = 2 * leaf + (bins[feature] > border)
    return leaf


def boost(
    features: np.ndarray, y: np.ndarray, n: np.ndarray, held: np.ndarray, inside: tuple[float, float], depth: int, rate: float,
    search: Search, spans: Sequence[slice] | None = None,
) -> dict:
    """Grow trees until validation stops improving. `inside` is the mean squared spread inside the cells, (training, held out).

    Without held-out rows the training rows stand in for them. `spans` gives the order in which the rows are taken.
    """
    spans = [slice(0, len(y))] if spans is None else spans
    alone = not any(held[part].any() for part in chunks(len(y)))
    train = Side.of(features, y, n, held, False, spans)
    edges = []
    for i in range(features.shape[1]):
        values = scratch(len(train.y), features.dtype)
        values[:] = train.features[i]
        edges.append(borders(values, search.bins))
    used = [i for i, e in enumerate(edges) if len(e)]
    n_bins = 1 + max((len(e) for e in edges), default=0)
    train.put_into_bins(edges)
    base = train.average(lambda part: train.y[part])
    train.at[:] = base
    if alone:
        val = Side(train.features, train.y, train.n, scratch(len(train.y), float))
    else:
        val = Side.of(features, y, n, held, True, spans)
        val.put_into_bins(edges)
    val.at[:] = base
    leaf = scratch(len(train.y), np.min_scalar_type((1 << depth) - 1))
    trees, values, curves, best = [], [], ([], []), 0
    while len(trees) < search.max_iter and len(trees) - 1 - best < search.patience:
        splits, (pull, weight) = grow_tree(train, used, leaf, depth, n_bins, search.l2)
        value = rate * pull / (weight + search.l2)
        for part in chunks(len(train.y)):
            train.at[part] += value[leaf[part]]
        for part in chunks(len(val.y)):
            val.at[part] += value[leaves_of(val.features[:, part], splits)]
        trees.append(splits)
        values.append(value)
        curves[0].append(train.error(inside[0]))
        curves[1].append(val.error(inside[1]))
        if curves[1][-1] < curves[1][best]:
            best = len(trees) - 1
    kept = best + 1
    gap = abs(curves[1][best] - min(curves[0]))
    return {
        "depth": depth, "learning_rate": rate, "trees": kept, "val_rmse": curves[1][best], "rmse_gap": gap,
        "total_score": curves[1][best] + search.gap_weight * gap, "base": base, "borders": [e.tolist() for e in edges],
        "splits": np.array(trees[:kept], np.int16).tobytes(), "leaves": np.array(values[:kept]).tobytes(),
        "train_curve": curves[0], "val_curve": curves[1],
    }


def model_values(model: Mapping, features: np.ndarray) -> np.ndarray:
    """Predictions of a fitted row (see `boost`)."""
    edges = [np.array(e) for e in model["borders"]]
    bins, depth = binned(features, edges), model["depth"]
    splits = np.frombuffer(model["splits"], np.int16).reshape(-1, depth, 2).tolist()
    leaves = np.frombuffer(model["leaves"]).reshape(-1, 1 << depth)
    found = np.full(len(features), model["base"])
    for tree, value in zip(splits, leaves):
        found += value[leaves_of(bins, tree)]
    return found


_TRIAL = "depth int, learning_rate double, trees int, val_rmse double, rmse_gap double, total_score double"
_FITTED = (
    f"GMM_CLUSTER int, measure string, trial int, {_TRIAL}, base double, borders array<array<double>>, splits binary, "
    "leaves binary, train_curve array<double>, val_curve array<double>"
)


def _matrix(features: pd.Series) -> np.ndarray:
    """Features in single precision, so that sums added up in another order are the same feature."""
    return np.array(features.tolist(), np.float32).astype(float).reshape(len(features), -1)


def _packed(width: int) -> np.dtype:
    return np.dtype([("is_holdout", "?"), ("n", "<i8"), ("y", "<f8"), ("ss", "<f8"), ("place", "<i8"), ("x", "<f4", (width,))])


def pack_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of each model in a batch as one binary value, `width` features each, in single precision as in `_matrix`."""
    for batch in batches:
        if not batch.num_rows:
            continue
        features = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        cells = np.empty(batch.num_rows, _packed(features.shape[1]))
        cells["x"] = features
        for c in ("is_holdout", "n", "y", "ss", "place"):
            cells[c] = batch.column(c).to_numpy(zero_copy_only=False)
        models = batch.select(MODEL).to_pandas().groupby(MODEL).indices
        keys = [pa.array([key[i] for key in models], kind) for i, kind in enumerate((pa.int32(), pa.string()))]
        width = pa.array([features.shape[1]] * len(models), pa.int32())
        texts = pa.array([cells[at].tobytes() for at in models.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([*keys, width, texts], [*MODEL, "width", "cells"])


@dataclass
class Fitted:
    """Category means, constants of the degenerate models, all trials with their curves, and the best model of each
    (cluster, measure)."""

    means: DataFrame
    constants: DataFrame
    models: DataFrame
    tried: DataFrame | None = None

    @property
    def trials(self) -> DataFrame:
        return self.tried.select(*MODEL, "trial", "depth", "learning_rate", "trees", "val_rmse", "rmse_gap", "total_score")

    @property
    def curves(self) -> DataFrame:
        """Learning curves of the best trials: `metric` (train_rmse, val_rmse), `step`, `value`."""
        one = [F.struct(F.lit(name).alias("metric"), F.col(c).alias("curve")) for name, c in (("train_rmse", "train_curve"), ("val_rmse", "val_curve"))]
        rows = self.models.select(*MODEL, F.inline(F.array(*one)))
        return rows.select(*MODEL, "metric", F.posexplode("curve").alias("step", "value"))

    def save(self, path: str) -> None:
        for name in ("means", "constants", "models"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str, clusters: Sequence[int] | None = None) -> Fitted:
        """All saved models, or those of the listed clusters."""
        tables = [spark.read.parquet(f"{path}/{name}") for name in ("means", "constants", "models")]
        if clusters is not None:
            tables = [t.filter(F.col("GMM_CLUSTER").isin(list(clusters))) for t in tables]
        return Fitted(*tables)


@dataclass(frozen=True)
class Training:
    """Cells with features (one row for all measures, a folder per cluster, its order in so many pieces), the category means, the
    constant models, and the (cluster, measure) to fit."""

    rows: DataFrame
    means: DataFrame
    constants: DataFrame
    measures: Sequence[str]
    models: Sequence[tuple[int, str]]
    pieces: int


def prepare_training(cells: DataFrame, conditions: Sequence[str] = CONDITION_COLUMNS) -> Training:
    """Write the cells with their statistics once: ordered ones for training cells, full ones for the held-out cells.

    Tables that are not needed afterwards, and the shuffle files of each step, go at once.
    """
    spark, combine = cells.sparkSession, len(conditions)
    folder = fresh_path(spark, "training")
    with work_folder(spark):
        cells = cut_clean(cells)
        constants = cut_clean(constant_models(cells), path=f"{folder}/constants")
        prior = cut(overall_means(cells))
        means = [
            cut_clean(category_means(cells, prior, c), path=f"{folder}/means-{j}") for j, c in enumerate(combinations(conditions, combine))
        ]
        means.append(cut(_unknown_means(prior), path=f"{folder}/means"))
        measures = _measures(cells)
        models = cells.select(*MODEL).distinct().join(constants, MODEL, "left_anti").collect()
        pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wide = wide_features(cells, measures, conditions, 1.0, combine, pieces, "float")
        every = range(len(measures))
        rows = wide.select(
            F.col("GMM_CLUSTER").cast("int").alias("GMM_CLUSTER"), "is_holdout", F.col("_place").alias("place"), *conditions,
            *[F.col(f"_{i}.{c}").alias(f"{c}_{i}") for i in every for c in ("n", "y", "ss")], *[f"_x{i}" for i in every],
        ).sortWithinPartitions("GMM_CLUSTER", "is_holdout", "place", *conditions).drop(*conditions)
        rows = cut_clean(rows, ["GMM_CLUSTER"], f"{folder}/rows")
    return Training(rows, reduce(DataFrame.unionByName, means), constants, measures, sorted((int(r[0]), r[1]) for r in models), pieces)


def in_order(cells: np.ndarray, pieces: int) -> list[slice]:
    """Stretches of packed cells that bring them into the order of (held out, place), whichever file came first: the files are
    sorted, and each piece of the order lies in one of them (see `wide_features`)."""
    starts, last = [], None
    for part in chunks(len(cells)):
        place, held = cells["place"][part], cells["is_holdout"][part].astype(np.int64)
        key, piece = place + (held << 60), ((place >> 30) * pieces >> 30) + held * pieces
        new = np.flatnonzero((key[1:] < key[:-1]) | (piece[1:] != piece[:-1])) + 1
        if last is None or key[0] < last[0] or piece[0] != last[1]:
            new = np.concatenate([[0], new])
        starts += [(int(key[i]), part.start + int(i)) for i in new]
        last = key[-1], piece[-1]
    ends = [at for _, at in starts[1:]] + [len(cells)]
    return [slice(at, end) for (_, at), end in sorted(zip(starts, ends))]


def fit_training(training: Training, search: Search = Search(), clusters: Sequence[int] | None = None) -> Fitted:
    """Fit every cluster and measure (or those of the listed clusters), each trial in a task of its own.

    The tasks read the cells of their model where they lie; nothing is dealt out.
    """
    spark = training.rows.sparkSession
    schema, pieces = to_arrow_schema(T.StructType.fromDDL(_FITTED)), training.pieces

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as file:
            for batch in filter(len, batches):
                trial = batch.column("trial")[0].as_py()
                for found in pack_cells([batch]):
                    cluster, measure, width, packed = (found.column(c)[0].as_py() for c in (*MODEL, "width", "cells"))
                    file.write(packed)
            if not file.tell():
                return
            file.flush()
            cells = np.asarray(np.memmap(file, _packed(width), "r"))
        spans, spread = in_order(cells, pieces), np.zeros((2, 2))
        for part in itertools.chain.from_iterable(map(chunks, spans)):
            held = cells["is_holdout"][part]
            spread += [[cells[c][part][side].sum() for c in ("ss", "n")] for side in (~held, held)]
        inside = [float(ss / max(n, 1)) for ss, n in (spread if spread[1, 1] else spread[[0, 0]])]
        candidate = search.candidates(cluster, measure)[trial]
        found = boost(cells["x"], cells["y"], cells["n"], cells["is_holdout"], inside, *candidate, search, spans)
        yield pa.RecordBatch.from_pylist([{"GMM_CLUSTER": cluster, "measure": measure, "trial": trial} | found], schema)

    tasks = []
    for cluster, measure in training.models:
        if clusters is None or cluster in clusters:
            i = training.measures.index(measure)
            cells = training.rows.filter(F.col("GMM_CLUSTER") == cluster).select(
                "GMM_CLUSTER", F.lit(measure).alias("measure"), "is_holdout", *[F.col(f"{c}_{i}").alias(c) for c in ("n", "y", "ss")],
                "place", F.col(f"_x{i}").alias("features"),
            ).filter(F.col("n").isNotNull())
            tasks += [cells.withColumn("trial", F.lit(trial)).coalesce(1) for trial in range(search.trials)]
    if tasks:
        # Else Spark takes tables of one partition each for parts of the same one.
        with settings(spark, spark__sql__unionOutputPartitioning="false"):
            tried = cut(reduce(DataFrame.union, tasks).mapInArrow(fit, _FITTED))
    else:
        tried = spark.createDataFrame([], _FITTED)
    first = F.struct("total_score", "trial")
    best = tried.groupBy(*MODEL).agg(F.min_by("trial", first).alias("trial"))
    return Fitted(training.means, training.constants, cut(tried.join(best, [*MODEL, "trial"])), tried)


def fit_models(
    cells: DataFrame,
    search: Search = Search(),
    conditions: Sequence[str] = CONDITION_COLUMNS,
    clusters: Sequence[int] | None = None,
) -> Fitted:
    return fit_training(prepare_training(cells, conditions), search, clusters)


def predict(
    facts: DataFrame,
    fitted: Fitted,
    names: Mapping[str, str] = PREDICTION_NAMES,
    conditions: Sequence[str] = CONDITION_COLUMNS,
) -> DataFrame:
    """Distinct conditions of each cluster with one predicted column per measure.

    `facts` may be any table with cluster and conditions, such as the cells. A measure without a model or a
    constant in a cluster is NULL there.
    """

    measures = list(names)
    value_columns = [f"Pred_{name}" for name in names.values()]

    def apply(rows: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        out = rows[keys].copy()
        fitted_rows = {m["measure"]: m for m in models.to_dict("records")}
        for i, (m, column) in enumerate(zip(measures, value_columns)):
            has_model = m in fitted_rows and len(rows)
            out[column] = model_values(fitted_rows[m], _matrix(rows[f"_{i}"])) if has_model else np.nan
        return out

    keys = ["GMM_CLUSTER", *conditions]
    schema = "GMM_CLUSTER int, " + ", ".join(f"`{c}` string" for c in conditions) + ", " + ", ".join(f"`{c}` double" for c in value_columns)
    constants = fitted.constants.groupBy("GMM_CLUSTER").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("value"))).cast("double").alias(f"_{i}") for i, m in enumerate(measures)]
    )

    def predicted(asked: DataFrame, n: int, means: DataFrame, fits: DataFrame) -> DataFrame:
        # No task holds a whole cluster: its conditions are parted by hash, and each part meets the models.
        parts = -(-n // PART_ROWS) or 1
        part = F.pmod(F.xxhash64(*conditions), F.lit(parts)).cast("int").alias("part")
        encoded = full_statistics(asked, means, conditions, len(conditions), measures).select("*", part)
        models = fits.filter(F.col("measure").isin(measures)).select(
            *MODEL, "depth", "base", "borders", "splits", "leaves", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
        )
        learned = encoded.groupBy("GMM_CLUSTER", "part").cogroup(models.groupBy("GMM_CLUSTER", "part")).applyInPandas(apply, schema)
        table = learned.join(F.broadcast(constants), "GMM_CLUSTER", "left")  # one row per cluster at most
        values = [F.coalesce(F.nanvl(c, F.lit(None).cast("double")), f"_{i}").alias(c) for i, c in enumerate(value_columns)]
        return table.select(*keys, *values)

    asked = cut_clean(distinct_conditions(facts, conditions).withColumn("GMM_CLUSTER", F.col("GMM_CLUSTER").cast("int")))
    sizes = {r.GMM_CLUSTER: r["count"] for r in asked.groupBy("GMM_CLUSTER").count().collect()}
    if sum(sizes.values()) <= SLICE_ROWS:
        return predicted(asked, sum(sizes.values()), fitted.means, fitted.models)
    # The joins write every condition once per combination, so clusters come one after another and each leaves only its result.
    folder, done = fresh_path(facts.sparkSession, "predicted"), []
    for cluster, n in sorted(sizes.items()):
        own = F.col("GMM_CLUSTER") == cluster
        with work_folder(facts.sparkSession):
            table = predicted(asked.filter(own), n, fitted.means.filter(own), fitted.models.filter(own))
            done.append(cut_clean(table, path=f"{folder}/{cluster}"))
    return reduce(DataFrame.union, done)

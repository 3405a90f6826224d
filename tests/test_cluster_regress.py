import hashlib
import itertools
import math
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from segmentry.operators import cluster, regress
from segmentry.plans import segments
from segmentry.session import cut


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(1)
    rows = [
        (i, rng.gauss(c, 0.3), rng.gauss(-c, 0.3), rng.gauss(c, 0.3)) for i, c in enumerate([0] * 200 + [6] * 200)
    ]
    return cut(spark.createDataFrame(rows, "MASTER_LABEL long, avg_CVR double, avg_ATS double, avg_E double"))


def test_two_blobs_are_found(spark, blobs):
    features = cluster.scaled_features(blobs)
    scores = cluster.bic_sweep(features, range(2, 5))
    assert cluster.best_k(scores) == 2
    groups = cluster.assign_clusters(features, 2).groupBy("GMM_CLUSTER").agg(
        F.min("MASTER_LABEL").alias("low"), F.max("MASTER_LABEL").alias("high")
    )
    assert sorted((r.low, r.high) for r in groups.collect()) == [(0, 199), (200, 399)]


def test_every_number_of_clusters_has_a_score(spark, blobs):
    """Ten labels, some of them equal: clusters of one label have no spread of their own."""
    few = blobs.filter("MASTER_LABEL % 40 = 0")
    features = cluster.scaled_features(few.unionByName(few.withColumn("MASTER_LABEL", F.col("MASTER_LABEL") + 1000)))
    scores = {r.k: r.bic for r in cluster.bic_sweep(features, range(2, 11)).collect()}
    assert sorted(scores) == list(range(2, 11)) and all(map(math.isfinite, scores.values()))


def as_points(features):
    return np.array([r.features.toArray() for r in features.orderBy("MASTER_LABEL").collect()])


def spark_mixture_likelihood(features, x, k):
    """Log-likelihood of the points under Spark's own mixture, fitted to copies moved by the ridge along every axis."""
    step = math.sqrt(x.shape[1] * cluster.RIDGE)
    copies = [(i, Vectors.dense(p + s * step * e)) for i, p in enumerate(x) for e in np.eye(x.shape[1]) for s in (-1, 1)]
    moved = features.sparkSession.createDataFrame(copies, ["i", "features"])
    model = GaussianMixture(k=k, seed=42, maxIter=100, tol=1e-3).fit(moved)
    rows = model.gaussiansDF.collect()
    parts = np.array(model.weights), np.array([r["mean"].toArray() for r in rows]), np.array([r["cov"].toArray() for r in rows])
    return cluster._total(cluster.log_densities(x, *parts)).sum()


def test_seeded_mixture_is_never_less_likely_than_sparks_own(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.2 + 0.3 * (i % 3), (25, 3)) for i, c in enumerate([0, 1, 2, 4, 7, 7.5])] + [np.zeros((5, 3))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "MASTER_LABEL long, a double, b double, c double")
    features = cluster.scaled_features(df)
    points = as_points(features)
    fits = {r.k: r for r in cluster.fit_mixtures(features, range(2, 11)).collect()}
    scores = {r.k: r.bic for r in cluster.bic_sweep(features).collect()}
    for k in range(2, 11):
        found = fits[k]
        parts = [np.array(found[c]) for c in ("weights", "means", "covariances")]
        # The value is that of the parameters, recomputed with plain determinants and inverses.
        dense = sum(
            w * np.exp(-0.5 * np.einsum("ni,ij,nj->n", points - m, np.linalg.inv(c), points - m)) / math.sqrt((2 * math.pi) ** 3 * np.linalg.det(c))
            for w, m, c in zip(*parts)
        )
        assert found.log_likelihood == pytest.approx(np.log(dense).sum(), rel=1e-6)
        assert scores[k] == pytest.approx(cluster.bic(found.log_likelihood, k, 3, len(x)), rel=1e-9)
        assert sum(found.weights) == pytest.approx(1) and all(np.linalg.eigvalsh(c).min() > 0.9e-6 for c in parts[2])
        assert found.log_likelihood >= spark_mixture_likelihood(features, points, k) - 0.05
    sizes = sorted(r["count"] for r in cluster.assign_clusters(features, 4).groupBy("GMM_CLUSTER").count().collect())
    own = cluster.log_densities(points, *[np.array(fits[4][c]) for c in ("weights", "means", "covariances")]).argmax(1)
    assert sizes == sorted(np.bincount(own).tolist())


def test_equal_labels_and_more_clusters_than_labels(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(4)], "MASTER_LABEL long, a double, b double")
    fits = cluster.fit_mixtures(cluster.scaled_features(df), [2, 6]).collect()
    assert sorted(r.k for r in fits) == [2, 6] and all(math.isfinite(r.log_likelihood) for r in fits)
    assert cluster.bic_sweep(cluster.scaled_features(df.limit(0))).collect() == []


def test_bic_formula():
    assert cluster.bic(-10.0, 2, 3, 100) == pytest.approx(20 + (2 * 3 + 2 * 6 + 1) * math.log(100))


def test_projection_is_centred_and_repeatable(spark, blobs):
    features = cluster.scaled_features(blobs)
    one, two = (cluster.project_2d(features).orderBy("MASTER_LABEL").collect() for _ in range(2))
    assert [(r.PCA_x, r.PCA_y) for r in one] == [(r.PCA_x, r.PCA_y) for r in two]
    assert sum(r.PCA_x for r in one) == pytest.approx(0, abs=1e-9)
    assert sum(r.PCA_x**2 for r in one) > 50 * sum(r.PCA_y**2 for r in one)


@pytest.mark.parametrize(
    "kind, expected",
    [("robust", [-1.0, -0.5, 0.0, 0.5, 23.5]), ("minmax", [0.0, 1 / 49, 2 / 49, 3 / 49, 1.0])],
)
def test_scalers(spark, kind, expected):
    df = spark.createDataFrame([(float(v), 5.0) for v in (1, 2, 3, 4, 50)], "a double, b double")
    got = cluster.Scaler.fit(df, ["a", "b"], kind).transform(df).orderBy("a").collect()
    assert [r.a for r in got] == pytest.approx(expected)
    assert [r.b for r in got] == [0.0] * 5


def test_unknown_scaler_is_refused(spark):
    with pytest.raises(ValueError):
        cluster.Scaler.fit(spark.createDataFrame([(1.0,)], "a double"), ["a"], "other")


def test_means_skip_missing_labels_and_values(spark):
    rows = [(0, 1.0, None, 2.0), (0, 3.0, None, 2.0), (1, 1.0, 1.0, 1.0), (None, 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "MASTER_LABEL long, CVR double, ATS double, `1000_W_EFFICIENCY` double")
    means = cluster.label_means(df).orderBy("MASTER_LABEL").collect()
    assert [tuple(r) for r in means] == [(0, 2.0, None, 2.0), (1, 1.0, 1.0, 1.0)]
    clusters = spark.createDataFrame([(1, 4)], "MASTER_LABEL long, GMM_CLUSTER int")
    assert sorted(str(r.GMM_CLUSTER) for r in cluster.attach_cluster(df, clusters).collect()) == ["4", "None", "None", "None"]


CONDITIONS = ["SHAPE", "MDA", "START_TIME"]


@pytest.fixture(scope="module")
def rows(spark):
    """Two clusters; CVR follows shape and media, ATS is constant in cluster 1, media 3 is one third of all rows."""
    rng = random.Random(4)
    data = []
    for i in range(900):
        c, shape, media = i % 2, rng.choice("xyz"), 3 if i % 3 == 0 else rng.randint(0, 5)
        cvr = {"x": 0.1, "y": 0.5, "z": 0.9}[shape] + media / 20 + rng.gauss(0, 0.02)
        data.append((c, shape, media, rng.choice(["AM", "PM"]), cvr, rng.random(), 0.5 if c else rng.random(), i))
    return cut(spark.createDataFrame(
        data, "GMM_CLUSTER int, SHAPE string, MDA long, START_TIME string, CVR double, "
        "`1000_W_EFFICIENCY` double, ATS double, KEY long",
    ))


SEARCH = regress.Search(trials=2, max_iter=60, depth=(3, 4), rate=(0.2, 0.4), patience=10)


@pytest.fixture(scope="module")
def fitted(rows):
    return regress.fit_models(regress.condition_cells(rows), SEARCH)


def test_cells_hold_all_rows(spark, rows):
    cells = regress.condition_cells(rows)
    total = cells.filter("measure = 'CVR'").agg(F.sum("n"), F.sum(F.col("n") * F.col("y")), F.sum("ss")).first()
    plain = rows.agg(F.count("CVR"), F.sum("CVR")).first()
    assert (total[0], total[1]) == (plain[0], pytest.approx(plain[1]))
    assert cells.count() == cells.select("GMM_CLUSTER", "measure", *CONDITIONS, "is_holdout").distinct().count()


def test_split_is_one_in_five_and_repeatable(rows):
    cells = regress.condition_cells(rows).filter("measure = 'CVR'")
    held = cells.filter("is_holdout").agg(F.sum("n")).first()[0]
    assert 120 < held < 240
    keys = ["GMM_CLUSTER", *CONDITIONS, "is_holdout", "n"]
    again = regress.condition_cells(rows.repartition(3)).filter("measure = 'CVR'")
    assert cells.select(keys).exceptAll(again.select(keys)).isEmpty()


def test_split_follows_the_plain_hash_of_the_keys(spark):
    """xxHash64 of the keys as eight bytes each, the hash of one key being the seed of the next; one row in five is held out."""
    rows = spark.range(500).select("id", (F.col("id") * 37 % 91 - 40).alias("b"), regress.holdout([F.col("id"), F.col("id") * 37 % 91 - 40]).alias("held"))
    for r in rows.collect():
        seed = 42
        for value in (r.id, r.b):
            seed = xxhash.xxh64(value.to_bytes(8, "little", signed=True), seed=seed).intdigest()
        signed = seed - 2**64 if seed >= 2**63 else seed
        assert r.held == (signed % 5 == 0)


def test_constant_target_needs_no_model(fitted):
    assert [(r.GMM_CLUSTER, r.measure, r.value) for r in fitted.constants.collect()] == [(1, "ATS", 0.5)]
    assert {(r.GMM_CLUSTER, r.measure) for r in fitted.models.collect()} == {
        (0, "CVR"), (0, "ATS"), (0, "1000_W_EFFICIENCY"), (1, "CVR"), (1, "1000_W_EFFICIENCY")
    }


def test_planted_effect_beats_the_mean(rows, fitted):
    spread = rows.agg(F.stddev_pop("CVR")).first()[0]
    best = fitted.trials.filter("measure = 'CVR'").agg(F.max("val_rmse")).first()[0]
    assert best < spread / 2


def test_curve_equals_the_error_over_single_rows(spark, rows, fitted):
    """The weighted cells give the same error as the rows they were made of."""
    is_holdout = regress.holdout([F.col("KEY"), F.col("MDA")])
    long = rows.select(
        "GMM_CLUSTER", *[F.col(c).cast("string").alias(c) for c in CONDITIONS], is_holdout.alias("is_holdout"),
        F.lit("CVR").alias("measure"), F.col("CVR").alias("y"),
    ).filter("GMM_CLUSTER = 0 and is_holdout")
    predicted = regress.predict(rows, fitted).select("GMM_CLUSTER", *CONDITIONS, F.col("Pred_CVR").alias("p"))
    error = long.join(predicted, ["GMM_CLUSTER", *CONDITIONS]).agg(F.sqrt(F.avg((F.col("p") - F.col("y")) ** 2))).first()[0]
    curve = [r.value for r in fitted.curves.filter("GMM_CLUSTER = 0 and measure = 'CVR' and metric = 'val_rmse'").collect()]
    assert min(curve) == pytest.approx(error)


def test_predictions_cover_every_condition(rows, fitted):
    got = regress.predict(rows, fitted)
    asked = rows.select("GMM_CLUSTER", *CONDITIONS).distinct().count()
    assert got.count() == asked
    assert got.filter("Pred_CVR is null or Pred_EFF is null or Pred_ATS is null").isEmpty()
    assert [r[0] for r in got.filter("GMM_CLUSTER = 1").select("Pred_ATS").distinct().collect()] == [0.5]


def test_unseen_category_gets_the_overall_mean(spark, fitted):
    asked = spark.createDataFrame([(0, "CVR", "never", "never", "never")], ["GMM_CLUSTER", "measure", *CONDITIONS])
    features = regress.encode(asked.withColumn("GMM_CLUSTER", F.col("GMM_CLUSTER").cast("int")), fitted.means).first()
    prior = fitted.means.filter("GMM_CLUSTER = 0 and measure = 'CVR' and column is null").first().encoded
    assert list(features.features) == [prior] * 3


def test_models_survive_saving(spark, rows, fitted, tmp_path):
    fitted.save(str(tmp_path))
    loaded = regress.Fitted.load(spark, str(tmp_path))
    assert regress.predict(rows, loaded).exceptAll(regress.predict(rows, fitted)).isEmpty()
    some = regress.Fitted.load(spark, str(tmp_path), [1]).models.collect()
    assert {(r.GMM_CLUSTER, r.measure) for r in some} == {(1, "CVR"), (1, "1000_W_EFFICIENCY")}


def test_listed_clusters_only(rows):
    one = regress.Search(trials=1, max_iter=1, depth=(2, 2))
    assert {r.GMM_CLUSTER for r in regress.fit_models(regress.condition_cells(rows), one, clusters=[1]).models.collect()} == {1}


def test_a_missing_category_costs_only_its_own_column(spark):
    """Rows of media 1 are 1 and 9, the 9 without a shape; the mean of all training rows is 4."""
    data = [(0, "CVR", "a", "1", "PM", False, 1, 1.0), (0, "CVR", None, "1", "PM", False, 1, 9.0), (0, "CVR", "a", "2", "AM", False, 1, 2.0)]
    cells = spark.createDataFrame(data, f"GMM_CLUSTER int, measure string, {', '.join(c + ' string' for c in CONDITIONS)}, is_holdout boolean, n long, y double")
    got = {(r.column, r.category): r.encoded for r in regress.target_means(cells).collect()}
    assert got[None, None] == 4.0
    assert got["MDA", "1"] == pytest.approx(14 / 3) and got["START_TIME", "PM"] == pytest.approx(14 / 3)
    assert got["SHAPE", "a"] == pytest.approx((3 + 4) / 3) and ("SHAPE", None) not in got


def test_clusters_without_values_keep_their_conditions(spark, rows, fitted):
    empty = spark.createDataFrame([(7, "x", 3, "AM"), (7, None, 3, "AM")], "GMM_CLUSTER int, SHAPE string, MDA long, START_TIME string")
    got = regress.predict(rows.select("GMM_CLUSTER", *CONDITIONS).limit(3).unionByName(empty), fitted)
    lost = got.filter("GMM_CLUSTER = 7")
    assert lost.count() == 2 and lost.filter("coalesce(Pred_CVR, Pred_EFF, Pred_ATS) is not null").isEmpty()


def test_curves_end_by_patience_and_no_tree_is_grown_twice(fitted, monkeypatch):
    for r in fitted.tried.collect():
        best = r.val_curve.index(min(r.val_curve)) + 1
        assert r.trees == best and len(r.train_curve) == len(r.val_curve)
        assert len(r.val_curve) == best + SEARCH.patience or len(r.val_curve) == SEARCH.max_iter
        assert r.rmse_gap == pytest.approx(abs(r.val_curve[best - 1] - min(r.train_curve)))
        assert r.total_score == pytest.approx(r.val_rmse + 0.7 * r.rmse_gap)
        assert len(r.splits) == 2 * 2 * best * r.depth and len(r.leaves) == 8 * best * 2**r.depth
    lowest = {}
    for r in fitted.tried.collect():
        key = r.GMM_CLUSTER, r.measure
        lowest[key] = min(lowest.get(key, (9e9, 0)), (r.total_score, r.trial))
    assert {(r.GMM_CLUSTER, r.measure): (r.total_score, r.trial) for r in fitted.models.collect()} == lowest
    grown, grow = [], regress.grow_tree
    monkeypatch.setattr(regress, "grow_tree", lambda *a: grown.append(1) or grow(*a))
    x, y, held = boosting_data()
    found = regress.boost(x, y, np.ones(len(y)), held, (0.0, 0.0), 3, 0.3, SEARCH)
    assert len(grown) == len(found["val_curve"])


def boosting_data():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (240, 3)).astype(float)
    return x, x[:, 0] * 0.5 + (x[:, 1] > 2) + rng.normal(0, 0.3, 240), np.arange(240) % 5 == 0


def plain_boost(x, y, n, held, depth, rate, trees, l2=3.0):
    """Every split of every level tried one by one, for all leaves together."""
    at, curve = np.full(len(y), np.average(y[~held], weights=n[~held])), []
    for _ in range(trees):
        leaf = np.zeros(len(y), int)
        for _ in range(depth):
            best = None
            for f in range(x.shape[1]):
                values = np.unique(x[~held, f])
                for edge in (values[1:] + values[:-1]) / 2:
                    side = 2 * leaf + (x[:, f] > edge)
                    gain = 0.0
                    for part in np.unique(side[~held]):
                        rows = ~held & (side == part)
                        gain += (n[rows] * (y - at)[rows]).sum() ** 2 / (n[rows].sum() + l2)
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, side
            leaf = best[1]
        step = np.zeros(len(y))
        for part in np.unique(leaf):
            rows = ~held & (leaf == part)
            if rows.any():
                step[leaf == part] = rate * (n[rows] * (y - at)[rows]).sum() / (n[rows].sum() + l2)
        at = at + step
        curve.append(math.sqrt(np.average((y - at)[held] ** 2, weights=n[held])))
    return at, curve


def test_boosting_equals_a_plain_one():
    x, y, held = boosting_data()
    n = 1 + np.arange(len(y)) % 4
    search = regress.Search(max_iter=8, patience=100)
    found = regress.boost(x, y, n, held, (0.0, 0.0), 3, 0.3, search)
    at, curve = plain_boost(x, y, n, held, 3, 0.3, 8)
    assert found["val_curve"] == pytest.approx(curve, rel=1e-9)
    kept = found["trees"]
    assert regress.model_values(found, x) == pytest.approx(plain_boost(x, y, n, held, 3, 0.3, kept)[0], rel=1e-9)


def test_features_without_spread_and_without_held_rows():
    x, y = np.ones((6, 2)), np.array([1.0, 2, 3, 4, 5, 6])
    found = regress.boost(x, y, np.ones(6), np.zeros(6, bool), (0.0, 0.0), 4, 0.1, regress.Search(max_iter=5))
    assert regress.model_values(found, x) == pytest.approx([3.5] * 6) and found["train_curve"] == found["val_curve"]


def test_ordered_statistics_leave_out_the_row_itself(spark, rows):
    """Against a plain walk over the cells in the order of their hash."""
    cells = regress.condition_cells(rows).filter("measure = 'CVR' and GMM_CLUSTER = 0")
    got = {(*(r[c] for c in CONDITIONS), r.column): r.encoded for r in regress.ordered_means(cells).collect()}
    train = [r for r in cells.collect() if not r.is_holdout]
    prior = sum(r.n * r.y for r in train) / sum(r.n for r in train)
    train.sort(key=lambda r: hashlib.md5("|".join(r[c] for c in CONDITIONS).encode()).hexdigest())
    sums = {}
    for r in train:
        for size in (1, 2, 3):
            for c in itertools.combinations(CONDITIONS, size):
                key = c, tuple(r[x] for x in c)
                total, n = sums.get(key, (0.0, 0))
                assert got[(*(r[x] for x in CONDITIONS), "+".join(c))] == pytest.approx((total + prior) / (n + 1))
                sums[key] = total + r.n * r.y, n + r.n
    assert len(got) == 7 * len(train)


def test_search_is_seeded_and_in_range():
    search = regress.Search(trials=40)
    found = search.candidates(3, "CVR")
    assert found == search.candidates(3, "CVR") and found != search.candidates(4, "CVR")
    assert all(4 <= d <= 8 and 0.005 <= r <= 0.05 for d, r in found)


def test_whole_chain(spark, tmp_path):
    """From facts to the master table: all rows labelled, tested, clustered, fitted, ranked and logged."""
    log = str(tmp_path / "runs")
    rng = random.Random(9)
    data = []
    for i in range(1500):
        os, quarter = rng.choice(["WEB", "ANDROID", "IOS"]), rng.choice(["1Q", "2Q", "3Q", "4Q"])
        level = {"WEB": 0.1, "ANDROID": 0.5, "IOS": 0.8}[os] + {"1Q": 0.0, "2Q": 0.05, "3Q": 0.1, "4Q": 0.15}[quarter]
        y = [level + rng.gauss(0, 0.03) for _ in range(3)]
        data.append((i, rng.randint(0, 3), os, quarter, "게임", "NONE", "LIMITED", rng.choice("xy"), rng.choice(["AM", "PM"]), *y))
    table = cut(spark.createDataFrame(
        data, "KEY long, MDA long, OS_TYPE string, START_QUARTER string, INDUSTRY string, REJOIN_TYPE string, "
        "LIMIT_TYPE string, SHAPE string, START_TIME string, CVR double, `1000_W_EFFICIENCY` double, ATS double",
    ))
    done = segments.run_segments(
        table, regress.Search(trials=1, max_iter=3, depth=(2, 3)), max_iter=20, log=log
    )
    assert list(done.levels) == ["OS_TYPE", "START_QUARTER"]
    assert done.labels.count() == 12 and done.facts.count() == 1500
    best = done.best.collect()
    assert {r.Metric_Type for r in best} == {"이익", "비용", "안정성"}
    assert max(r.Rank for r in best) <= 10
    assert segments.tests_from_log(spark, log).count() == 15
    assert {r.experiment for r in spark.read.parquet(log).select("experiment").distinct().collect()} == {
        "group_tests", "mixture", "trials", "curves"
    }
    assert spark.read.parquet(log).filter("experiment = 'mixture'").agg(F.countDistinct("step")).first()[0] == 9


def test_category_means_are_never_broadcast(spark, rows, fitted):
    """The table of means is a small file and a large hash table; only the overall means, a row per cluster, go to all tasks."""
    asked = rows.select("GMM_CLUSTER", *CONDITIONS).withColumn("MDA", F.col("MDA").cast("string")).distinct()
    features = regress.full_statistics(asked, fitted.means, CONDITIONS, 3)
    features.collect()
    text = features._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("SortMergeJoin") == 7 and text.count("BroadcastHashJoin") <= 1


@pytest.mark.parametrize("pieces", [1, 5])
def test_cell_features_equal_plain_sums(spark, rows, pieces):
    """Training cells see the training cells before them, held-out cells all of them, whichever way the order is cut."""
    cells = regress.condition_cells(rows.withColumn("SHAPE", F.when(F.col("KEY") % 11 != 0, F.col("SHAPE"))))
    found = cells.collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", pieces)
    try:
        got = {(r.GMM_CLUSTER, r.measure, r.SHAPE, r.MDA, r.START_TIME, r.is_holdout): r.features for r in regress.cell_features(cells).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(found)
    names = sorted(("+".join(c), c) for c in regress.combinations(CONDITIONS, 3))

    def place(r):
        return hashlib.md5("|".join(r[c] or "" for c in CONDITIONS).encode()).hexdigest()

    for r in found[::7]:
        train = [x for x in found if not x.is_holdout and (x.GMM_CLUSTER, x.measure) == (r.GMM_CLUSTER, r.measure)]
        prior = sum(x.n * x.y for x in train) / sum(x.n for x in train)
        seen = train if r.is_holdout else [x for x in train if place(x) < place(r)]
        expected = []
        for _, columns in names:
            same = [x for x in seen if all(x[c] is not None and x[c] == r[c] for c in columns)]
            expected.append((sum(x.n * x.y for x in same) + prior) / (sum(x.n for x in same) + 1))
        key = (r.GMM_CLUSTER, r.measure, r.SHAPE, r.MDA, r.START_TIME, r.is_holdout)
        assert got[key] == pytest.approx(expected)


def test_packed_cells_hold_every_value_and_take_little_room():
    n, rng = 5_000, np.random.default_rng(2)
    features = rng.random((n, 7))
    columns = {
        "GMM_CLUSTER": pa.array(np.arange(n, dtype=np.int32) % 2), "measure": pa.array(["CVR"] * n), "is_holdout": pa.array(np.arange(n) % 5 == 0),
        "n": pa.array(np.arange(n)), "y": pa.array(rng.random(n)), "ss": pa.array(rng.random(n)), "place": pa.array(np.arange(n)[::-1].copy()),
        "features": pa.array(features.tolist()),
    }
    packed = pa.Table.from_batches(regress.pack_cells([pa.RecordBatch.from_pydict(columns)])).to_pylist()
    assert [(r["GMM_CLUSTER"], r["measure"], r["width"]) for r in packed] == [(0, "CVR", 7), (1, "CVR", 7)]
    for r in packed:
        cells = np.frombuffer(r["cells"], regress._packed(7))
        own = np.arange(n) % 2 == r["GMM_CLUSTER"]
        assert len(r["cells"]) == 61 * own.sum() and np.array_equal(cells["x"], features[own].astype(np.float32))
        for c in ("is_holdout", "n", "y", "ss", "place"):
            assert np.array_equal(cells[c], columns[c].to_numpy(zero_copy_only=False)[own])


def many_cells(n, width=7):
    rng = np.random.default_rng(8)
    cells = np.zeros(n, regress._packed(width))
    cells["x"] = rng.random((n, width))
    cells["y"] = cells["x"][:, 0] + (cells["x"][:, 1] > 0.3)
    cells["n"], cells["place"], cells["is_holdout"] = 1 + np.arange(n) % 3, np.arange(n), np.arange(n) >= 0.8 * n
    return cells


def test_a_training_task_takes_memory_for_a_part_of_its_cells_only(tmp_path):
    """1.2 million cells are 73 MB; what the task allocates beside its files is a few columns of one part."""
    cells = many_cells(1_200_000)
    cells.tofile(tmp_path / "cells")
    del cells
    mapped = np.memmap(tmp_path / "cells", regress._packed(7), "r")
    tracemalloc.start()
    found = regress.boost(mapped["x"], mapped["y"], mapped["n"], mapped["is_holdout"], (0.0, 0.0), 4, 0.3, regress.Search(max_iter=2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found["val_curve"]) == 2 and peak < 45e6


def test_parts_and_files_do_not_change_the_trees(monkeypatch):
    cells = many_cells(5_000)
    args = cells["x"], cells["y"], cells["n"], cells["is_holdout"], (0.0, 0.0), 4, 0.3, regress.Search(max_iter=6)
    whole = regress.boost(*args)
    monkeypatch.setattr(regress, "CHUNK_ROWS", 700)
    monkeypatch.setattr(regress, "FILE_BYTES", 0)
    parts = regress.boost(*args)
    assert parts["splits"] == whole["splits"] and parts["borders"] == whole["borders"]
    assert parts["val_curve"] == pytest.approx(whole["val_curve"], rel=1e-12)
    assert [e.tolist() for e in (regress.borders(np.float32([3, 1, 1, 2, 1] * 600), 32), regress.borders(np.float32([5] * 900), 32))] == [[1.5, 2.5], []]


@pytest.mark.parametrize("chunk", [64, 1 << 17])
def test_cells_are_taken_in_one_order_whichever_file_comes_first(monkeypatch, chunk):
    monkeypatch.setattr(regress, "CHUNK_ROWS", chunk)
    cells = many_cells(1_000)
    places = np.random.default_rng(1).integers(0, 1 << 60, 1_000)
    cells["place"] = np.concatenate([np.sort(places[:800]), np.sort(places[800:])])
    pieces = ((cells["place"] >> 30) * 5 >> 30) + 5 * cells["is_holdout"]
    files = [cells[np.isin(pieces, own)] for own in ([0, 3, 6], [1, 2, 9], [4, 5], [7, 8])]
    came = np.concatenate([files[i] for i in (2, 0, 3, 1)])
    spans = regress.in_order(came, 5)
    assert b"".join(came[s].tobytes() for s in spans) == cells.tobytes() != came.tobytes()
    one, two = (
        regress.boost(c["x"], c["y"], c["n"], c["is_holdout"], (0.0, 0.0), 3, 0.3, regress.Search(max_iter=4), regress.in_order(c, 5)) for c in (cells, came)
    )
    assert one["splits"] == two["splits"] and one["val_curve"] == two["val_curve"]


def shuffled_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_training_deals_no_cells_out_and_leaves_no_shuffle_files(spark, rows):
    cells = cut(regress.condition_cells(rows))
    training = regress.prepare_training(cells)
    before = shuffled_bytes(spark)
    for _ in range(20):  # the files go a moment after the query
        regress.prepare_training(cells)
        if shuffled_bytes(spark) <= before + 20_000:
            break
    stages = spark._jsc.sc().statusStore().stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
    last = max(stages.apply(i).stageId() for i in range(stages.size()))
    fitted = regress.fit_training(training, SEARCH)
    stages = spark._jsc.sc().statusStore().stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
    new = [stages.apply(i) for i in range(stages.size()) if stages.apply(i).stageId() > last]
    fits = max(new, key=lambda stage: stage.numTasks())
    assert fits.numTasks() == 5 * SEARCH.trials and fits.inputRecords() > 0 and fits.shuffleReadRecords() == 0
    assert fitted.tried.count() == 5 * SEARCH.trials


def test_clusters_predicted_one_after_another_give_the_same_rows(rows, fitted, monkeypatch):
    whole = sorted(map(tuple, regress.predict(rows, fitted).collect()))
    monkeypatch.setattr(regress, "SLICE_ROWS", 1)
    assert sorted(map(tuple, regress.predict(rows, fitted).collect())) == whole


def test_label_means_leave_no_shuffle_files(spark, blobs):
    facts = spark.range(200_000).selectExpr("id % 50 AS MASTER_LABEL", "rand(1) AS CVR", "rand(2) AS ATS", "rand(3) AS `1000_W_EFFICIENCY`")
    before = shuffled_bytes(spark)
    assert cluster.scaled_features(cluster.label_means(facts.repartition(8, "CVR"))).count() == 50
    for _ in range(50):  # the files go a moment after the query
        if shuffled_bytes(spark) <= before + 50_000:
            break
        time.sleep(0.1)
    assert shuffled_bytes(spark) <= before + 50_000  # the dealt rows alone are some 5 MB

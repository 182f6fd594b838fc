"""Models: against numpy where there is one answer, otherwise thresholds and shapes."""

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans, KMeansModel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import functions as F

from tidemill.ml import features, jobs
from tidemill.operators.aggregates import observed


@pytest.fixture(scope="module")
def points(spark):
    """Three clouds in two dimensions, class = cloud."""
    rng = np.random.default_rng(3)
    rows = []
    for label, (x, y) in enumerate([(0, 0), (10, 0), (0, 10)]):
        for dx, dy in rng.normal(0, 1, (120, 2)):
            rows.append((len(rows), float(x + dx), float(y + dy), float(label)))
    df = spark.createDataFrame(rows, "id int, x double, y double, label double")
    return features.assemble(df, ["x", "y"], ["id", "label"])


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 3))
    y = x @ [2.0, -1.0, 0.5] + 3.0 + rng.normal(0, 0.1, 400)
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label double")
    return features.assemble(df, ["a", "b", "c"], ["id", "label"]), x, y


def test_split_is_stable(points):
    a, b = features.split(points, ["id"])
    again, _ = features.split(points.repartition(7), ["id"])
    ids = lambda d: sorted(r.id for r in d.select("id").collect())
    assert ids(a) == ids(again) and not set(ids(a)) & set(ids(b))
    assert a.count() + b.count() == points.count()


def test_linear_regression_is_least_squares(lines):
    df, x, y = lines
    model = jobs.linear_regression(df, "label")
    design = np.column_stack([x, np.ones(len(y))])
    want = np.linalg.lstsq(design, y, rcond=None)[0]
    assert np.allclose([*model.coefficients, model.intercept], want, atol=1e-6)
    scored = model.transform(df)
    by_hand = scored.agg(F.avg(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert jobs.mean_absolute_error(scored, "label") == pytest.approx(by_hand)


def test_elastic_net_stages(spark):
    rows = [("ab"[i % 2], float(i % 10), 3.0 * (i % 10) + 5 * (i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "c string, v double, price double")
    model = jobs.elastic_net_stages("c", ["v"], "price").fit(df)
    scored = features.label_names(model.stages[0], "_category", "back").transform(
        model.transform(df))
    assert scored.filter("back <> c").count() == 0
    assert jobs.mean_absolute_error(scored, "price") < 3
    assert len(model.stages[2].coefficients) == 2


def test_index_ties_are_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacccd"], "v string")
    model, indexed = features.index_labels(df, "v", "i")
    assert list(model.labels) == ["c", "a", "b", "d"]
    back = features.label_names(model, "i", "w").transform(indexed)
    assert back.filter("v <> w").count() == 0


def test_logistic_regression(points):
    two = points.filter("label < 2")
    train, test = features.split(two, ["id"])
    scored = jobs.logistic_regression(train, "label", iterations=100).transform(test)
    assert jobs.class_metric(scored, "label", "accuracy") > 0.97


@pytest.mark.parametrize("fit", [jobs.logistic_regression, jobs.random_forest])
def test_binary_models_after_observed_metrics(points, fit):
    watched, seen = observed(points, n=F.count(F.lit(1)))
    watched.count()
    assert seen.get == {"n": 360}
    scored = fit(points.filter("label < 2"), "label").transform(points)
    assert scored.repartition(3).count() == 360


@pytest.mark.parametrize("fit", [jobs.decision_tree, jobs.random_forest])
def test_tree_classifiers(points, fit):
    train, test = features.split(points, ["id"])
    scored = fit(train, "label").transform(test)
    assert jobs.class_metric(scored, "label", "accuracy") > 0.95
    assert jobs.class_metric(scored, "label", "weightedRecall") > 0.95
    assert jobs.class_metric(scored, "label", "f1") > 0.95
    table = jobs.confusion(scored, "label", "prediction")
    assert table.agg(F.sum("cnt")).first()[0] == scored.count()


def test_deep_tree_parameters(points):
    assert jobs.decision_tree(points, "label", depth=20, bins=500).depth <= 20


def test_regression_tree(points):
    df = points.withColumn("label", F.col("label") * 10)
    assert jobs.mean_absolute_error(jobs.regression_tree(df, "label").transform(df), "label") < 0.5


def test_kmeans_is_a_fixed_point(points, tmp_path):
    model = jobs.kmeans(points)
    centers = np.array(model.clusterCenters())
    rows = model.transform(points).select("features", "prediction").collect()
    x = np.array([r.features.toArray() for r in rows])
    nearest = ((x[:, None] - centers[None]) ** 2).sum(-1).argmin(1)
    assert list(nearest) == [r.prediction for r in rows]
    for k in range(3):
        assert np.allclose(x[nearest == k].mean(0), centers[k])
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = KMeansModel.load(str(tmp_path / "m"))
    assert np.allclose(loaded.clusterCenters(), centers)


def test_elbow_falls(points):
    costs = [r.cost for r in jobs.elbow(points, [2, 3, 5]).orderBy("k").collect()]
    assert costs[0] > costs[1] > costs[2]


def test_elbow_is_as_kmeans_in_one_pass_per_iteration(spark, points, monkeypatch):
    ks = [2, 3, 5, 9]
    models = [KMeans(featuresCol="features", k=k, maxIter=1000, seed=1).fit(points) for k in ks]
    passes = []

    def watched(blocks, task, centres, run=jobs._over_blocks):
        passes.append(list(centres))
        return run(blocks, task, centres)

    monkeypatch.setattr(jobs, "_over_blocks", watched)
    got = [r.cost for r in jobs.elbow(points, ks).orderBy("k").collect()]
    assert np.allclose(got, [m.summary.trainingCost for m in models], rtol=1e-9)
    # as many passes as the slowest k has iterations, and one for the costs
    assert len(passes) == max(m.summary.numIter for m in models) + 1
    assert passes[0] == passes[-1] == ks


def test_gaussian_mixture(points):
    model = jobs.gaussian_mixture(points)
    assert sorted(round(w, 1) for w in model.weights) == [0.3, 0.3, 0.3]


def test_gaussian_mixture_is_as_sparks_over_blocks(spark, points, monkeypatch, tmp_path):
    passes = []

    def watched(blocks, task, parts, over=jobs._over_blocks):
        passes.append(blocks.count())
        return over(blocks, task, parts)

    monkeypatch.setattr(jobs, "_over_blocks", watched)
    theirs = GaussianMixture(k=3, maxIter=30, seed=1).fit(points)
    ours = jobs.gaussian_mixture(points, iterations=30)
    assert len(passes) == theirs.summary.numIter and max(passes) < points.count()
    np.testing.assert_allclose(ours.weights, theirs.weights, rtol=1e-6)
    for a, b in zip(ours.gaussians, theirs.gaussians):
        np.testing.assert_allclose(a.mean.toArray(), b.mean.toArray(), rtol=1e-6)
        np.testing.assert_allclose(a.cov.toArray(), b.cov.toArray(), rtol=1e-6)
    ours.save(str(tmp_path / "mixture"))
    loaded = GaussianMixtureModel.load(str(tmp_path / "mixture"))
    labels = [[r.prediction for r in m.transform(points).sort("id").collect()] for m in (ours, theirs, loaded)]
    assert labels[0] == labels[1] == labels[2]
    nowhere = points.sparkSession.createDataFrame([(float("inf"), 1.0)], "x double, y double")
    with pytest.raises(Exception, match="infinite"):
        jobs.gaussian_mixture(features.assemble(nowhere.union(nowhere), ["x", "y"]))


def test_als(spark, tmp_path):
    rng = np.random.default_rng(6)
    u, v = rng.uniform(0.5, 1.5, (30, 2)), rng.uniform(0.5, 1.5, (20, 2))
    rows = [(i, j, float(u[i] @ v[j])) for i in range(30) for j in range(20)]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    train, test = features.split(df, ["user", "item"])
    model = jobs.als(train, "user", "item", "rating", rank=4)
    assert jobs.mean_absolute_error(model.transform(test), "rating") < 0.3
    users = df.filter("user < 2").select("user").distinct()
    best = model.recommendForUserSubset(users, 3).collect()
    assert len(best) == 2 and all(len(r.recommendations) == 3 for r in best)
    model.write().overwrite().save(str(tmp_path / "als"))
    assert ALSModel.load(str(tmp_path / "als")).rank == 4


def plain_als(**options):
    return ALS(userCol="user", itemCol="item", ratingCol="rating", regParam=0.01, coldStartStrategy="nan", seed=1, **options)


def factors_of(model):
    sides = model.userFactors, model.itemFactors
    return [{r.id: np.array(r.features) for r in side.collect()} for side in sides]


def skewed_ratings(spark):
    """One user has rated every item, one item was rated by every user; some pairs come twice."""
    rng = np.random.default_rng(8)
    pairs = {(int(u), int(i)) for u, i in rng.integers(0, (70, 400), (2500, 2))}
    pairs |= {(7, i) for i in range(400)} | {(u, -3) for u in range(70)}
    rows = [(u, i, float(rng.integers(1, 50))) for u, i in sorted(pairs)]
    rows += [(u, i, 25.0) for u, i, _ in rows[::9]]
    return spark.createDataFrame(rows, "user int, item int, rating double")


@pytest.mark.parametrize("small", [False, True])
def test_als_is_the_plain_one(spark, monkeypatch, small):
    df = skewed_ratings(spark)
    if small:  # many blocks of few rows, factors in several batches
        monkeypatch.setattr(jobs, "EQUATION_BYTES", 20 * 5 * 5 * 8)
        monkeypatch.setattr(jobs, "BATCH_BYTES", 30 * 5 * 4)
    ours = jobs.als(df, "user", "item", "rating", rank=5, iterations=4)
    theirs = plain_als(rank=5, maxIter=4).fit(df)
    for got, want in zip(factors_of(ours), factors_of(theirs)):
        assert got.keys() == want.keys()
        assert all(np.allclose(got[k], want[k], rtol=1e-3, atol=1e-4) for k in want)
    scored = [
        [r.prediction for r in model.transform(df).sort("user", "item", "rating").collect()]
        for model in (ours, theirs)
    ]
    assert np.allclose(*scored, atol=1e-3)


def test_als_shuffles_no_factors(spark):
    """a further iteration shuffles nothing."""
    df = skewed_ratings(spark)
    shuffles = spark.sparkContext._jsc.sc().newShuffleId

    def taken(iterations):
        before = shuffles()
        jobs.als(df, "user", "item", "rating", rank=3, iterations=iterations)
        return shuffles() - before

    assert taken(1) == taken(4)


@pytest.mark.parametrize("bad", [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan")), (1, 1, float("inf"))])
def test_als_refuses(spark, bad):
    df = spark.createDataFrame([(1, 2, 3.0), bad], "user int, item int, rating double")
    with pytest.raises(ValueError, match="whole numbers"):
        jobs.als(df, "user", "item", "rating", rank=2, iterations=1)
    with pytest.raises(Exception, match="MUST NOT"):
        plain_als(rank=2, maxIter=1).fit(df)


def test_frequent_sets(spark):
    baskets = [["a", "b"], ["a", "b", "c"], ["a"], ["c"]]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    got = {r["items"]: r["freq"] for r in jobs.frequent_sets(df, "items", 0.5).collect()}
    assert got == {"a": 3, "b": 2, "c": 2, "a,b": 2}


def test_principal_components(lines):
    df, x, _ = lines
    model = jobs.principal_components(df, 3)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    want = vectors[:, ::-1]
    assert np.allclose(np.abs(model.pc.toArray()), np.abs(want), atol=1e-6)
    assert np.allclose(model.explainedVariance, values[::-1] / values.sum())

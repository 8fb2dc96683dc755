"""Classifiers against brute force and on separable data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.operators import knn, linear, trees
from lexispark.operators.bayes import fit_complement_nb, predict_complement_nb
from lexispark.operators.ranking import spread_join
from lexispark.operators.vocabulary import TfidfConfig
from lexispark.plans import predict
from lexispark.plans.features import text_features
from lexispark.session import materialize


def _rows(spark, matrix, labels, start=0):
    data = []
    for i, (x, y) in enumerate(zip(matrix, labels)):
        n = np.linalg.norm(x)
        at = [j for j, v in enumerate(x) if v != 0]
        data.append((start + i, y, at, [float(x[j] / n) for j in at]))
    return spark.createDataFrame(data, "id long, y string, idx array<int>, w array<double>")


def _brute(train, labels, test, k):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    sims = np.round(unit(test) @ unit(train).T, 9)
    out = []
    for row in sims:
        out.append([i for _, _, i in sorted((-s, labels[i], i) for i, s in enumerate(row))[:k]])
    return out


@pytest.mark.parametrize("block_rows", [7, 32, 4096])
@pytest.mark.parametrize("k", [1, 2, 5])
def test_knn_equals_brute_force(spark, block_rows, k):
    rng = np.random.default_rng(k)
    centres = rng.normal(size=(4, 6))
    train = centres[rng.integers(0, 4, 90)] + 0.3 * rng.normal(size=(90, 6))
    train[10] = train[11] = train[12] = train[40]  # copies with different labels
    train[60] = 0.0
    train[20:50:3, :3] = 0.0
    labels = [str(v) for v in rng.integers(0, 3, 90)]
    test = centres[rng.integers(0, 4, 40)] + 0.3 * rng.normal(size=(40, 6))
    test[3] = train[40]
    test[4] = test[5]
    test[6] = 0.0
    near = knn.knn_neighbours(_rows(spark, train, labels), _rows(spark, test, ["x"] * 40).drop("y"), "id", "y", 6, k,
                              block_rows=block_rows)
    got = {}
    for r in near.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    assert got == dict(enumerate(_brute(train, labels, test, k)))


def test_knn_with_one_large_group_of_copies(spark):
    train = np.array([[1.0, 0.0]] * 200 + [[0.0, 1.0]] * 3 + [[0.0, 0.0]] * 5)
    labels = ["b"] * 150 + ["a"] * 50 + ["c"] * 8
    test = np.array([[1.0, 0.1]] * 50 + [[0.0, 1.0], [0.0, 0.0]])
    near = knn.knn_neighbours(_rows(spark, train, labels), _rows(spark, test, ["x"] * 52).drop("y"), "id", "y", 2, 3,
                              block_rows=4)
    got = {}
    for r in near.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    assert got == dict(enumerate(_brute(train, labels, test, 3)))


@pytest.mark.parametrize("tile_rows", [8, 40])
def test_knn_over_several_tiles(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(knn, "QUERIES_AT_ONCE", 5)
    rng = np.random.default_rng(tile_rows)
    centres = rng.normal(size=(4, 6))
    train = centres[rng.integers(0, 4, 90)] + 0.3 * rng.normal(size=(90, 6))
    train[30:60, 1:] = 0.0  # many distances of the same size
    train[60] = train[61] = 0.0
    labels = [str(v) for v in rng.integers(0, 3, 90)]
    test = centres[rng.integers(0, 4, 40)] + 0.3 * rng.normal(size=(40, 6))
    test[6] = 0.0
    near = knn.knn_neighbours(_rows(spark, train, labels), _rows(spark, test, ["x"] * 40).drop("y"), "id", "y", 6, 3,
                              block_rows=7, tile_rows=tile_rows)
    got = {}
    for r in near.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    assert got == dict(enumerate(_brute(train, labels, test, 3)))


def test_knn_sends_a_query_once_for_each_tile(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(knn, "materialize", lambda df, name: (lambda out: (sent.append((name, out)), out)[1])(materialize(df, name)))
    rng = np.random.default_rng(1)
    train, test = rng.normal(size=(300, 6)), rng.normal(size=(40, 6))
    near = knn.knn_neighbours(_rows(spark, train, ["a"] * 300), _rows(spark, test, ["x"] * 40).drop("y"), "id", "y", 6, 2,
                              block_rows=8, tile_rows=100)
    assert near.count() == 80
    routes = sum(df.select(F.sum(F.size("tiles"))).first()[0] for name, df in sent if "tiles" in df.columns)
    assert routes <= 40 * 5  # 300 rows in blocks of 8 would be 38 for each query


def test_vote_rules(spark):
    rows = [
        (1, "b", 0.5, 1), (1, "a", 0.25, 2),     # the nearer one wins
        (2, "b", 0.0, 1), (2, "a", 1e-12, 2),    # two zero distances: a tie, smaller label
        (3, "b", 0.0, 1), (3, "a", 0.1, 2),      # zero distance leaves the other without a vote
        (4, "b", 0.3, 1), (4, "a", 0.3, 2),      # tie
    ]
    near = spark.createDataFrame(rows, "id long, y string, distance double, rank int")
    assert {r.id: r.predicted for r in knn.vote(near, "id", "y").collect()} == {1: "a", 2: "a", 3: "b", 4: "a"}


def _train_reference(x, y, classes, bs_rows, epochs, lr, reg):
    """Mini-batch descent on dense arrays, batches given as row lists per epoch."""
    n = len(y)
    w, b = np.zeros((len(classes), x.shape[1])), np.zeros(len(classes))
    for c, name in enumerate(classes):
        t = np.array([v == name for v in y], float)
        pos, neg = n / (2 * t.sum()), n / (2 * (n - t.sum()))
        for e in range(epochs):
            for rows in bs_rows[e]:
                sw = np.where(t[rows] == 1, pos, neg)
                err = (1 / (1 + np.exp(-(x[rows] @ w[c] + b[c]))) - t[rows]) * sw
                w[c] -= lr * (x[rows].T @ err / sw.sum() + reg * w[c])
                b[c] -= lr * err.sum() / sw.sum()
    return w, b


def test_ovr_sgd_equals_dense_training(spark):
    from lexispark.operators.split import epoch_batches

    rng = np.random.default_rng(0)
    y = [["a", "b", "c"][i % 3 if i % 7 else 0] for i in range(50)]
    x = rng.normal(size=(50, 4)) + np.array([{"a": 0, "b": 2, "c": -2}[v] for v in y])[:, None]
    x[5] = 0.0
    x[:, 1][::2] = 0.0
    rows = _rows(spark, x, y)
    dense = np.array([v / (np.linalg.norm(v) or 1) for v in x])
    cfg = linear.SgdConfig(batch_size=16, epochs=3, learning_rate=0.5, reg_strength=1e-2, seed=5)
    batches = []
    for e in range(3):
        placed = epoch_batches(rows.select("id"), "id", 16, 5, e).collect()
        batches.append([sorted(r.id for r in placed if r.batch == b) for b in range(4)])
    assert [len(b) for b in batches[0]] == [16, 16, 16, 2]
    want_w, want_b = _train_reference(dense, y, ["a", "b", "c"], batches, 3, 0.5, 1e-2)
    model = linear.fit_ovr(rows, "id", "y", 4, cfg)
    assert np.allclose(model.weights, want_w) and np.allclose(model.bias, want_b)


def test_single_class_is_an_error(spark):
    rows = _rows(spark, np.eye(3), ["a"] * 3)
    for fit in (lambda: linear.fit_ovr(rows, "id", "y", 3),
                lambda: linear.fit_ovr_mllib(linear.ml_vectors(rows, 3), "y", "logistic")):
        with pytest.raises(ValueError):
            fit()
    flags = spark.createDataFrame([(True,), (True,)], "good boolean")
    with pytest.raises(Exception, match="both classes"):
        linear.binary_class_weights(flags, "good").collect()


def test_complement_nb_by_hand(spark):
    weights = spark.createDataFrame(
        [(1, "a", "x", 1.0), (2, "b", "x", 0.6), (2, "b", "y", 0.8)], "id long, y string, term string, w double")
    alpha = 0.5
    counts = np.array([[1.0, 0.0], [0.6, 0.8]])
    rest = counts.sum(0) + alpha - counts
    logged = np.log(rest / rest.sum(1, keepdims=True))
    for norm, want in ((False, -logged), (True, logged / logged.sum(1, keepdims=True))):
        theta = {r.term: r.theta for r in fit_complement_nb(weights, ["a", "b"], "y", alpha, norm).collect()}
        assert np.allclose([[theta[t][c] for t in "xy"] for c in (0, 1)], want)
    docs = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    theta = fit_complement_nb(weights, ["a", "b"], "y", alpha)
    got = {r.id: r.predicted for r in predict_complement_nb(docs, weights, theta, "id", ["a", "b"]).collect()}
    assert got == {1: "a", 2: "b", 3: "a"}  # no known term: the first class


@pytest.fixture(scope="module")
def separable(spark):
    """Three topics with words of their own, one of them frequent."""
    words = {"a": "alpha atom axis acid", "b": "beta boat bird band", "c": "cell coin cube cord"}
    rows = []
    for i in range(120):
        y = "a" if i % 2 else ("b" if i % 4 else "c")
        w = words[y].split()
        rows.append((i, f"{w[i % 4]} {w[(i // 4) % 4]} common {w[(i // 2) % 4]}", y))
    df = spark.createDataFrame(rows, "id long, t string, y string")
    return text_features(df.where("id < 90"), df.where("id >= 90"), "id", "t", "y", TfidfConfig(max_features=20))


@pytest.mark.parametrize("name, fit", [
    ("complement_nb", lambda f: predict.complement_nb(f)),
    ("sgd", lambda f: predict.logistic_sgd(f, linear.SgdConfig(batch_size=45, epochs=5))),
    ("logistic", lambda f: predict.logistic_mllib(f, 10.0, 20)),
    ("svc", lambda f: predict.linear_svm(f, 1.0, 20)),
    ("squared hinge", lambda f: predict.linear_svm(f, 1.0, 15, squared_hinge=True)),
    ("knn", lambda f: predict.nearest_neighbours(f)),
    ("knn svd", lambda f: predict.nearest_neighbours_svd(f, 8)),
    ("svd logistic", lambda f: predict.svd_logistic(f, 8, 10.0, True)),
    ("forest", lambda f: predict.random_forest(f, trees.ForestConfig(n_trees=10, max_depth=8))),
    ("boosted", lambda f: predict.boosted_trees(f, trees.BoostingConfig(n_rounds=3, max_depth=3))),
])
def test_models_separate_topics(separable, name, fit):
    rows = fit(separable).collect()
    assert sorted(r.id for r in rows) == list(range(90, 120))
    assert np.mean([r.y == r.predicted for r in rows]) > 0.9


def test_forest_settings():
    assert trees.ForestConfig(min_samples_split=5, min_samples_leaf=2).leaf_rows() == 3
    assert trees.ForestConfig(min_samples_split=2, min_samples_leaf=2).leaf_rows() == 2


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    got = {r.y: r.class_weight for r in linear.with_class_weights(df, "y").collect()}
    assert got == {"a": 4 / 6, "b": 2.0}
    binary = linear.binary_class_weights(df.select((F.col("y") == "b").alias("p")), "p").first()
    assert (binary.pos_weight, binary.neg_weight) == (2.0, 4 / 6)


def test_forest_depth_is_never_cut_silently():
    from lexispark.operators.trees import ForestConfig

    assert ForestConfig(max_depth=None).depth() == 30 and ForestConfig(max_depth=4).depth() == 4
    with pytest.raises(ValueError):
        ForestConfig(max_depth=31).depth()


def test_deviation_of_large_values(spark):
    from lexispark.operators.profile import numeric_summary

    big = spark.createDataFrame([(10**9 + k, k) for k in range(5)] + [(None, None)], "a long, b long")
    found = {r.column_name: r for r in numeric_summary(big, ["a", "b"]).collect()}
    assert abs(found["a"].std - 2.5**0.5) < 1e-6 and found["a"].q50 == 10**9 + 2 and found["b"]["count"] == 5


def test_complement_nb_with_many_classes(spark):
    n = 60
    rows = [(k % n, f"t{k * 7 % 11}", 1.0 + k % 5) for k in range(400)]
    table = spark.createDataFrame(rows, "y int, term string, w double")
    terms = sorted({t for _, t, _ in rows})
    counts = np.zeros((len(terms), n))
    for y, t, w in rows:
        counts[terms.index(t), y] += w
    rest = counts.sum(1, keepdims=True) + 0.5 - counts
    logged = np.log(rest / rest.sum(0))
    for norm, expected in ((False, -logged), (True, logged / logged.sum(0))):
        theta = fit_complement_nb(table, list(range(n)), "y", 0.5, norm)
        found = {r.term: r.theta for r in theta.select("term", "theta").collect()}
        assert np.allclose([found[t] for t in terms], expected)


def test_models_trained_together_equal_those_trained_alone(spark, monkeypatch):
    rng = np.random.default_rng(4)
    tables = []
    for n, n_features, labels in ((70, 6, "abc"), (41, 3, "bd"), (10, 4, "ab")):
        rows = [(i, labels[i % len(labels)], list(range(n_features)), rng.standard_normal(n_features).tolist()) for i in range(n)]
        tables.append((spark.createDataFrame(rows, "id long, label string, idx array<int>, w array<double>"), n_features))
    cfg = linear.SgdConfig(batch_size=16, epochs=2)
    alone = [linear.fit_ovr(rows, "id", "label", n, cfg) for rows, n in tables]
    jobs, one = [], linear._batch_gradients
    monkeypatch.setattr(linear, "_batch_gradients", lambda *a: jobs.append(1) or one(*a))
    together = linear.fit_ovr_together(tables, "id", "label", cfg)
    assert len(jobs) == 2 * 5  # the updates of the largest table, not of all three
    for a, b in zip(alone, together):
        assert a.classes == b.classes
        np.testing.assert_allclose(a.weights, b.weights, rtol=1e-9)
        np.testing.assert_allclose(a.bias, b.bias, rtol=1e-9)


def test_salted_copies_are_never_broadcast(spark):
    big = spark.range(60).select("id", (F.col("id") % 3).cast("string").alias("k"))
    small = spark.createDataFrame([("0", 5), ("0", 6), ("1", 7), (None, 8)], "k string, v int")
    joined = spread_join(big, small, ["k"], ["id"], "inner")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.v) for r in joined.collect()) == sorted((i, v) for i in range(60) for k, v in ((0, 5), (0, 6), (1, 7)) if i % 3 == k)


@pytest.mark.parametrize("loss", ["log", "squared_hinge"])
def test_many_small_updates_are_one_job_an_epoch(spark, monkeypatch, loss):
    rng = np.random.default_rng(6)
    tables = []
    for n, n_features, labels in ((90, 6, "abc"), (31, 3, "bd")):
        rows = [(i, labels[i % len(labels)], list(range(n_features)) if i % 7 else [], rng.standard_normal(n_features if i % 7 else 0).tolist()) for i in range(n)]
        tables.append((spark.createDataFrame(rows, "id long, label string, idx array<int>, w array<double>"), n_features))
    cfg = linear.SgdConfig(batch_size=4, epochs=2, loss=loss, learning_rate=0.1)
    one = linear._batch_gradients
    monkeypatch.setattr(linear, "_batch_gradients", None)  # a job for each update
    streamed = linear.fit_ovr_together(tables, "id", "label", cfg)
    monkeypatch.setattr(linear, "_batch_gradients", one)
    monkeypatch.setattr(linear, "STREAMED_UPDATES", 10**6)
    for a, b in zip(streamed, linear.fit_ovr_together(tables, "id", "label", cfg)):
        assert a.classes == b.classes
        np.testing.assert_allclose(a.weights, b.weights, rtol=1e-9)
        np.testing.assert_allclose(a.bias, b.bias, rtol=1e-9)

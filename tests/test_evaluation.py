"""Metrics, searches and reports on hand-made results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.operators import metrics as M
from lexispark.plans import report, search
from lexispark.plans.evaluate import cross_validate


def test_macro_f1_counts_labels_of_both_sides(spark):
    # c is never predicted, d never true: both count as 0
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "d")]
    df = spark.createDataFrame(rows, "y string, p string")
    r = M.evaluate(df, "y", "p").first()
    assert (r.n, r.accuracy) == (4, 0.5)
    assert abs(r.macro_f1 - (2 / 3 + 2 / 3 + 0 + 0) / 4) < 1e-12
    assert M.accuracy(df, "y", "p").first().accuracy == 0.5


def test_fold_summary_uses_population_deviation(spark):
    df = spark.createDataFrame([(0, 0.2, 0.5), (1, 0.4, 0.5)], "fold int, macro_f1 double, accuracy double")
    r = M.summarize_folds(df).first()
    assert abs(r.mean_macro_f1 - 0.3) < 1e-12 and abs(r.std_macro_f1 - 0.1) < 1e-12 and r.std_accuracy == 0


def test_cross_validate_sees_each_row_once(spark):
    df = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.lit("a").alias("y"))
    seen = []

    def fit(train, val):
        seen.append((train.count(), val.count()))
        return val.withColumn("predicted", F.lit("a"))

    scores = cross_validate(df, "fold", range(3), fit, "y").collect()
    assert seen == [(20, 10)] * 3 and all(r.n == 10 and r.macro_f1 == 1 for r in scores)


def test_grid(spark):
    g = search.grid(spark, a=[1, 2], b=["x", "y", "z"])
    assert [(r.candidate, r.a, r.b) for r in g.orderBy("candidate").collect()] == [
        (1, 1, "x"), (2, 1, "y"), (3, 1, "z"), (4, 2, "x"), (5, 2, "y"), (6, 2, "z")]


def test_schedules():
    names = lambda n, rows: [c for c, _ in search.halving_schedule(n, rows, 3, 2)]
    assert names(80, 100_000) == [80, 27, 9, 3]
    assert names(384, 100_000) == [384, 128, 43, 15, 5, 2]
    assert names(432, 100_000) == [432, 144, 48, 16, 6, 2]
    assert search.halving_schedule(9, 900, 3, 2) == [(9, 100), (3, 300), (1, 900)]
    # few rows: fewer rounds, never below the minimum
    assert search.halving_schedule(81, 40, 3, 2) == [(81, 12), (27, 36)]
    with pytest.raises(ValueError):
        search.halving_schedule(9, 10, 3, 2)


def test_halving_and_finalists(spark):
    candidates = search.grid(spark, x=[1, 2, 3, 4, 5, 6, 7, 8, 9])
    shares = []

    def one_round(left, share):
        shares.append(round(share, 3))
        return left.select("candidate", (F.col("x") / 10 + share / 100).alias("mean_macro_f1"),
                           F.lit(0.0).alias("mean_accuracy"))

    results = search.halving_search(candidates, one_round, 900, 3, 2)
    assert shares == [0.111, 0.333, 1.0]
    assert {r["round"]: r.n for r in results.groupBy("round").agg(F.count("*").alias("n")).collect()} == {0: 9, 1: 3, 2: 1}
    # candidate 9 was in all rounds and is listed once
    top = search.finalists(results, 5).orderBy("candidate_rank_tuning").collect()
    assert [r.candidate for r in top] == [9, 8, 7, 6, 5]


def test_select_best(spark):
    schema = "candidate int, alpha double, mean_macro_f1 double, mean_accuracy double"
    tuning = spark.createDataFrame([(1, 0.1, 0.9, 0.9)], schema)
    validation = spark.createDataFrame([(2, 0.2, 0.5, 0.6), (3, 0.3, 0.5, 0.7)], schema)
    empty = spark.createDataFrame([], schema)
    assert search.select_best(validation, tuning, ["alpha"]).first().alpha == 0.3
    assert search.select_best(None, tuning, ["alpha"]).first().alpha == 0.1
    assert search.select_best(empty, tuning, ["alpha"]).first().alpha == 0.1
    for nothing in ((None, None), (empty, empty)):
        with pytest.raises(ValueError):
            search.select_best(*nothing, ["alpha"])


def test_typed_params(spark):
    df = spark.createDataFrame([("5000.0", "0.1", "None", "True"), ("2.5", "x", "30", "")],
                               "a string, b string, c string, d string")
    rows = search.typed_params(df, {"a": "int", "b": "double", "c": "int", "d": "boolean"}).collect()
    assert [tuple(r) for r in rows] == [(5000, 0.1, None, True), (None, None, 30, None)]


def test_trials_stay_in_range_and_repeat(spark):
    space = {"n": ("int", 400, 1000), "r": ("log", 0.01, 0.1), "s": ("float", 0.6, 0.9), "m": ("choice", [80, 120, 150])}
    one = search.trials(spark, 200, 1, space).collect()
    assert one == search.trials(spark, 200, 1, space).collect()
    assert all(400 <= t.n <= 1000 and 0.01 <= t.r <= 0.1 and 0.6 <= t.s <= 0.9 for t in one)
    assert {t.m for t in one} == {80, 120, 150}
    assert 0.4 < sum(t.r < 10**-1.5 for t in one) / 200 < 0.6


def test_reports(spark):
    score = lambda f, a: spark.createDataFrame([(f, a)], "macro_f1 double, accuracy double")
    table = report.model_comparison({"x": score(0.5, 0.9), "y": score(0.7, 0.1), "z": score(0.5, 0.95)})
    assert [r.model for r in table.collect()] == ["y", "z", "x"]
    fs = spark.createDataFrame([(100, 0.1), (500, 0.2)], "max_features long, f double")
    svd = spark.createDataFrame([(50, 0.3), (200, 0.4)], "n_components long, f double")
    combined = report.combined_report({"svd": (svd, "n_components"), "fs": (fs, "max_features")}).collect()
    assert [(r.method, r["size"]) for r in combined] == [("fs", 500), ("fs", 100), ("svd", 200), ("svd", 50)]


def test_bayes_folds_inside_the_row_equal_joins(spark, monkeypatch):
    from lexispark.plans import search

    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, "abc"[i % 3], i % 4, " ".join(rng.choice(words[(i % 3) * 8: (i % 3) * 8 + 14], 12))) for i in range(60)]
    rows += [(5, "c", 0, "w1 w1 w20"), (5, "c", 0, "w1 w2"), (6, "a", 1, "w9"), (6, "a", 2, "w9 w10")]  # repeated keys
    rows += [(None, "a", 0, "w3 w4"), (None, "b", 1, "w3 w25 w25"), (90, None, 2, "w7 w8"), (91, "b", 3, ""), (92, "b", 3, None)]
    docs = spark.createDataFrame(rows, "id long, y string, fold int, text string")
    candidates = search.grid(spark, ngram_max=[1, 2], min_df=[1, 2], max_features=[10, 25], sublinear_tf=[True, False],
                             alpha=[0.5], norm=[False, True])
    written = []
    monkeypatch.setattr(search, "materialize", lambda df, name: (written.append(name), df)[1])

    def scores(train):
        found = search.cnb_cross_validation(docs, "id", "y", "fold", "text", candidates, 4, train_scores=train)
        return {(r.candidate, r.part, r.fold): (r.n, round(r.accuracy, 9), round(r.macro_f1, 9)) for r in found.collect()}

    inside = scores(True), scores(False)
    assert "cv-weights" not in written  # no table of documents times terms times vocabularies
    monkeypatch.setattr(search, "BROADCAST_CELLS", 0)
    assert (scores(True), scores(False)) == inside and inside[1]

"""Splits are exact, seeded and stable under repartitioning."""

import pytest
from pyspark.sql import functions as F

from lexispark.operators import split as S
from lexispark.operators.ranking import seeded_rank


@pytest.fixture(scope="module")
def rows(spark):
    # one class holds most of the rows
    return spark.range(2000).select(
        "id", F.when(F.col("id") % 10 == 0, "b").when(F.col("id") % 25 == 1, "c").otherwise("a").alias("y"))


def test_rank_is_a_permutation(rows):
    got = seeded_rank(rows, "id", 1, ["y"], digits=1)
    for y, n in (("a", 1720), ("b", 200), ("c", 80)):
        ranks = sorted(r["rank"] for r in got.where(F.col("y") == y).collect())
        assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == n
    moved = {(r.id, r["rank"]) for r in seeded_rank(rows.repartition(7), "id", 1, ["y"], digits=2).collect()}
    assert moved == {(r.id, r["rank"]) for r in got.collect()}


def test_folds_are_balanced(rows):
    folds = S.stratified_folds(rows, "id", "y", 3, 42).groupBy("fold", "y").count().collect()
    total = {}
    for y in "abc":
        sizes = [r["count"] for r in folds if r.y == y]
        assert max(sizes) - min(sizes) <= 1 and len(sizes) == 3
    for r in folds:
        total[r.fold] = total.get(r.fold, 0) + r["count"]
    assert max(total.values()) - min(total.values()) <= 1
    with pytest.raises(ValueError):
        S.stratified_folds(rows, "id", "y", 1, 42)


def test_holdout_quota(rows):
    held = S.stratified_holdout(rows, "id", "y", 0.2, 42).where("is_holdout").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in held} == {"a": 344, "b": 40, "c": 16}


def test_sample(rows):
    one = {r.id for r in S.sample_fraction(rows, "id", 0.25, 7).collect()}
    assert len(one) == 500 and one == {r.id for r in S.sample_fraction(rows.repartition(5), "id", 0.25, 7).collect()}
    assert one != {r.id for r in S.sample_fraction(rows, "id", 0.25, 8).collect()}
    assert S.sample_fraction(rows, "id", 1.0, 7).count() == 2000
    for bad in (0, 1.5, -1):
        with pytest.raises(ValueError):
            S.sample_fraction(rows, "id", bad, 7)


def test_batches(rows):
    batched = S.epoch_batches(rows, "id", 512, 3, 0).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in batched] == [512, 512, 512, 464]
    first = {r.id for r in S.epoch_batches(rows, "id", 512, 3, 0).where("batch = 0").collect()}
    assert first != {r.id for r in S.epoch_batches(rows, "id", 512, 3, 1).where("batch = 0").collect()}


def test_subsamples_are_nested(rows):
    folded = S.stratified_folds(rows, "id", "y", 3, 42)
    small, large = (
        {r.id for r in S.nested_subsample(folded, "id", "y", "fold", share, 42).collect()} for share in (1 / 9, 1 / 3))
    assert small < large
    assert S.nested_subsample(folded, "id", "y", "fold", 1.0, 42).count() == 2000

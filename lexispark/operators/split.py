"""Seeded splits, samples and mini-batches that depend on the row key only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lexispark.operators.ranking import seeded_rank


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("_n"))


def stratified_holdout(df: DataFrame, key: str, label: str, fraction: float, seed: int,
                       out: str = "is_holdout") -> DataFrame:
    """Mark ``ceil(fraction * n)`` rows, shared out over the classes by largest remainder.

    The windows without a partition run over the class counts, one row per class.
    """
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie between 0 and 1")
    everything = Window.partitionBy()
    quota = (
        _class_counts(df, label)
        .withColumn("_total", F.sum("_n").over(everything))
        .withColumn("_want", F.ceil(F.col("_total") * F.lit(fraction)))
        .withColumn("_exact", F.col("_n") * F.col("_want").cast("double") / F.col("_total"))
        .withColumn("_whole", F.floor("_exact"))
        .withColumn("_left", F.col("_want") - F.sum("_whole").over(everything))
        .withColumn("_turn", F.row_number().over(
            Window.orderBy(F.round(F.col("_exact") - F.col("_whole"), 9).desc(), label)))
        .select(label, (F.col("_whole") + (F.col("_turn") <= F.col("_left")).cast("int")).alias("_quota"))
    )
    ranked = seeded_rank(df, key, seed, [label], "_rank", per_group=quota)
    return ranked.withColumn(out, F.col("_rank") <= F.col("_quota")).drop("_rank", "_quota")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int, out: str = "fold") -> DataFrame:
    """Deal the shuffled rows of one class after the other to ``k`` folds in turn.

    Fold sizes differ by at most one, both overall and per class.
    """
    if k < 2:
        raise ValueError("at least two folds are needed")
    offsets = _class_counts(df, label).select(
        label,
        F.coalesce(F.sum("_n").over(Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_offset"),
    )
    ranked = seeded_rank(df, key, seed, [label], "_rank", per_group=offsets)
    return ranked.withColumn(
        out, ((F.col("_offset") + F.col("_rank") - 1) % k).cast("int")
    ).drop("_rank", "_offset")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """``round(fraction * n)`` rows, exactly."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be over 0 and at most 1")
    n = df.agg(F.count("*")).scalar()
    return seeded_rank(df, key, seed, (), "_rank").where(
        F.col("_rank") <= F.round(n * F.lit(float(fraction)))
    ).drop("_rank")


def epoch_batches(df: DataFrame, key: str, batch_size: int, seed: int, epoch: int, out: str = "batch", by: tuple[str, ...] = ()) -> DataFrame:
    """Shuffle the rows (of each group ``by``) anew for each epoch and cut them into batches; the last one may be short."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    ranked = seeded_rank(df, key, f"{seed}|{epoch}", by, "_rank")
    return ranked.withColumn(out, F.floor((F.col("_rank") - 1) / batch_size).cast("long")).drop("_rank")


def nested_subsample(df: DataFrame, key: str, label: str, fold: str, share: float, seed: int) -> DataFrame:
    """The first ``ceil(share * n)`` rows of each class in each fold.

    A larger share contains every smaller one, since the order does not change.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be over 0 and at most 1")
    size = df.groupBy(fold, label).agg(F.count("*").alias("_n"))
    ranked = seeded_rank(df, key, seed, [fold, label], "_rank", per_group=size)
    return ranked.where(
        F.col("_rank") <= F.ceil(F.round(F.col("_n") * F.lit(float(share)), 9))
    ).drop("_rank", "_n")

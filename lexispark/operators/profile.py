"""Table profiles: counts, class distribution, length statistics, histograms, samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lexispark.functions.hashing import seeded_key
from lexispark.functions.text import word_count

QUARTILES = (0.25, 0.5, 0.75)


def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name, rows, columns."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_cells(df: DataFrame) -> DataFrame:
    """Null cells per column and in total, in one pass."""
    per_column = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    counted = df.agg(*per_column)
    total = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
    return counted.select(*[F.col(c).alias(f"null_{c}") for c in df.columns], total.alias("null_total"))


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.countDistinct(label).alias("n_classes"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and percent (two decimals) of each label.

    The total comes from the counted labels, so the table is read once.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 2)).orderBy(label)


def with_taxonomy(df: DataFrame, taxonomy: DataFrame, label: str) -> DataFrame:
    """Left join; labels the taxonomy does not know stay with a null category."""
    return df.join(taxonomy, label, "left")


def top_labels(df: DataFrame, label: str, taxonomy: DataFrame, n: int = 20, unknown: str = "Unknown") -> DataFrame:
    """The ``n`` most frequent labels with their category and percent."""
    top = class_distribution(df, label).orderBy(F.desc("n"), label).limit(n)
    named = with_taxonomy(top, taxonomy.select(label, "category"), label)
    return named.withColumn("category", F.coalesce("category", F.lit(unknown))).orderBy(F.desc("n"), label)


def text_lengths(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(
        key,
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_chars"),
        word_count(F.col(text)).alias("n_words"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of integer columns.

    All columns are taken in one pass of long rows.  The deviation merges partial moments, so large values close
    together keep theirs; the percentile works on distinct values and their frequencies.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])
    values = df.select(F.explode(pairs).alias("p")).select("p.column_name", "p.x")
    moments = values.groupBy("column_name").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    counted = values.where("x is not null").groupBy("column_name", "x").agg(F.count("*").alias("n"))
    ranks = counted.groupBy("column_name").agg(F.percentile("x", list(QUARTILES), F.col("n")).alias("_q"))
    return moments.join(ranks, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min",
        F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max",
    )


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram; every bin is half open but the last one, empty bins are kept."""
    x = F.col(column).cast("double")
    pad = F.when(F.min(x) == F.max(x), F.lit(0.5)).otherwise(F.lit(0.0))
    bounds = df.agg(F.struct((F.min(x) - pad).alias("lo"), (F.max(x) + pad).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    place = F.least(F.floor((x - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
    counted = df.where(x.isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").alias("bin"))
        .join(counted, "bin", "left")
        .select(
            "bin",
            (lo + F.col("bin") * (hi - lo) / bins).alias("bin_start"),
            (lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("bin_end"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
    )


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in a seeded random order."""
    return df.orderBy(seeded_key(seed, key), key).limit(n)


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)

"""Exact ranks and top-k without putting a whole table, or a whole hot group, into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexispark.functions.hashing import hex_prefix, seeded_key


def seeded_rank(
    df: DataFrame,
    key: str,
    seed: int | str,
    by: Sequence[str] = (),
    out: str = "rank",
    digits: int = 3,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Rank (from 1) of every row in the seeded random order of ``key`` within ``by``.

    The hash is uniform, so its first hex digits cut each group, however large,
    into ``16 ** digits`` even ranges.  A row's rank is its place in its range plus
    the size of the ranges before it; only those sizes are ever summed in one place.
    ``key`` must be unique.  ``df`` is read twice, so give it the key and group columns only and join the
    result where texts or vectors are needed.  Columns of ``per_group(by..., ...)`` are added on the way: they are joined
    to the range sizes, so that no row is shuffled by its group alone.
    """
    by = list(by)
    hashed = df.withColumn("_h", seeded_key(seed, key)).withColumn("_range", hex_prefix(F.col("_h"), digits))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*by, "_range")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    if per_group is not None:
        offsets = offsets.join(per_group, by)
    within = Window.partitionBy(*by, "_range").orderBy("_h", key)
    return (
        hashed.withColumn("_rn", F.row_number().over(within))
        .join(offsets, [*by, "_range"])
        .withColumn(out, (F.col("_rn") + F.col("_before")).cast("long"))
        .drop("_h", "_range", "_rn", "_before")
    )


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    spread_on: str,
    by: Sequence[str] = (),
    out: str = "rank",
    slices: Sequence[int] = (1024, 32),
) -> DataFrame:
    """The first ``k`` rows of each group with their rank, exactly.

    The members of the overall top ``k`` are in the top ``k`` of their hash slice.  The slices get
    fewer from step to step, so that the last step, one task per group, sees at most
    ``slices[-1] * k`` rows, however many rows and tasks there were.
    """
    by = list(by)
    for n in slices:
        local = Window.partitionBy(*by, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", F.pmod(F.xxhash64(spread_on), F.lit(n)))
            .withColumn("_local", F.row_number().over(local))
            .where(F.col("_local") <= k)
            .drop("_local", "_slice")
        )
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(out) <= k)


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], spread_on: Sequence[str], fits: bool
                ) -> DataFrame:
    """Inner join that broadcasts ``small`` if its checked size allows, and spreads hot keys otherwise."""
    return big.join(F.broadcast(small), list(keys)) if fits else spread_join(big, small, keys, spread_on, "inner")


def spread_join(big: DataFrame, small: DataFrame, keys: Sequence[str], spread_on: Sequence[str], how: str = "left",
                salts: int = 16) -> DataFrame:
    """Equi-join in which one key of ``big`` may hold a large part of all rows.

    ``big`` is split over ``salts`` slices, and each row of ``small`` goes to all of them.  The copies are shuffled, never
    broadcast: the planner knows the stored size of ``small`` only, not that of its copies.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_on), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.array(*[F.lit(s) for s in range(salts)])))
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")

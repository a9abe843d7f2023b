"""Sequences of numbers: weighted medians, centred means, cuts between lines, tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.text import let


def weighted_median(df: DataFrame, key: str, value: str = "v", weight: str = "w", out: str = "median") -> DataFrame:
    """(key, median): the first value, from the least, by which half of the weight is reached. Equal values are added up
    before they are ordered, so a group is ordered by its distinct values."""
    sums = df.groupBy(key, F.col(value).alias("v")).agg(F.sum(weight).alias("w"))
    by = Window.partitionBy(key)
    run = sums.withColumn("run", F.sum("w").over(by.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("w").over(by))
    return run.where(F.col("run") >= F.col("all") / 2).groupBy(key).agg(F.min("v").alias(out))


def robust_median(df: DataFrame, key: str, value: str = "v", weight: str = "w", near: float = 2.5, least: int = 3) -> DataFrame:
    """(key, median): the weighted median again over values near the first one, where enough are; 0 for small groups."""
    first = weighted_median(df, key, value, weight, "first")
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    close = df.join(first, key).where(F.abs(F.col(value) - F.col("first")) <= near)
    enough = close.groupBy(key).agg(F.count("*").alias("k")).where(F.col("k") >= least)
    second = weighted_median(close.join(enough, key, "left_semi"), key, value, weight, "second")
    rows = n.join(first, key).join(second, key, "left")
    return rows.select(key, F.when(F.col("n") < least, F.lit(0.0)).otherwise(F.coalesce("second", "first")).alias("median"))


def centered_mean(value: Column, window, half: int) -> Column:
    """The sum of a value and its neighbours to ``half`` places, over the full width also at the ends."""
    return F.sum(value).over(window.rowsBetween(-half, half)) / F.lit(2 * half + 1)


def line_safe_cuts(profile: Column, tiles: int, search: float = 0.25) -> Column:
    """Where to cut a page with a row profile into ``tiles`` tiles: near the even cuts, at rows with little ink, each cut
    a least distance after the one before."""
    height = F.size(profile)
    nominal_height = height / tiles
    core = F.greatest(F.lit(40), (nominal_height * F.lit(0.55)).cast("int"))

    def step(cuts: Column, n: Column) -> Column:
        nominal = F.bround(n * nominal_height).cast("int")
        radius = F.greatest(F.lit(20), (nominal_height * F.lit(search)).cast("int"))
        before = F.when(F.size(cuts) > 0, F.try_element_at(cuts, F.lit(-1)) + core).otherwise(core)
        lower, upper = F.greatest(nominal - radius, before), F.least(nominal + radius, height - (F.lit(tiles) - n) * core)

        def choose(b: Column) -> Column:
            ink = F.slice(profile, b["lower"] + 1, b["upper"] - b["lower"] + 1)

            def best(local: Column) -> Column:
                ranked = F.array_sort(local)
                at = (F.size(ranked) - 1) * F.lit(0.75)
                low, high = F.get(ranked, F.floor(at).cast("int")), F.get(ranked, F.ceil(at).cast("int"))
                scale = F.greatest(low + (high - low) * (at - F.floor(at)), F.lit(1e-6))
                return let(
                    scale,
                    lambda s: F.array_min(
                        F.transform(local, lambda v, i: F.struct((v + F.abs(b["lower"] + i - nominal) / F.greatest(F.lit(1), radius) * s * F.lit(0.08)).alias("score"), (b["lower"] + i).alias("at")))
                    )["at"],
                )

            return F.when(b["lower"] >= b["upper"], nominal).otherwise(let(ink, best))

        return F.array_append(cuts, let(F.struct(lower.alias("lower"), upper.alias("upper")), choose))

    return F.aggregate(F.sequence(F.lit(1), F.lit(tiles - 1)), F.array().cast("array<int>"), step)


def tile_bounds(cuts: Column, height: Column, overlap: float = 0.15) -> Column:
    """Array of (tile, top, bottom) between the cuts, widened by a share of the tile height except at the page's ends."""
    n = F.size(cuts) + 1
    extra = (height / n * F.lit(overlap)).cast("int")
    edges = F.concat(F.array(F.lit(0)), cuts, F.array(height))
    return let(
        edges,
        lambda e: F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                i.alias("tile"), F.when(i > 0, F.greatest(F.lit(0), F.get(e, i) - extra)).otherwise(F.get(e, i)).alias("top"),
                F.when(i < n - 1, F.least(height, F.get(e, i + 1) + extra)).otherwise(F.get(e, i + 1)).alias("bottom"),
            ),
        ),
    )

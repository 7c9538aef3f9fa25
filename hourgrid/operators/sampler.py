"""The next parameters to try, from the log of those tried: densities of good and of other trials.

A parameter is suggested where the density of the good trials is large against that of the others. Both are sums of normal
kernels over the scaled range plus one uniform part, which stands for what was never tried; parameters are looked at
one by one. The draw follows from the log alone, so a search can be repeated and continued.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of the trials that count as good.
GOOD_SHARE = 0.25
#: Candidates stand at these many kernel widths from each good trial.
OFFSETS = (-1.6, -1.0, -0.6, -0.3, -0.1, 0.1, 0.3, 0.6, 1.0, 1.6)


def kernel_width(n: Column) -> Column:
    """Kernel width among `n` trials, as a share of the range."""
    return F.pow(n + 1, F.lit(-0.2)) / 4


def densities(trials: DataFrame, ranges: dict[str, tuple[float, float]], logarithmic: Sequence[str] = ()) -> DataFrame:
    """(name, u, good_density, other_density) of all candidates; u is the place in the range from 0 to 1.

    Trials without an error, as failed ones, are left out. The log is small; the sums run by parameter and candidate.
    """

    def scaled(name: str) -> Column:
        low, high = (math.log(x) if name in logarithmic else float(x) for x in ranges[name])
        x = F.ln(F.col(name)) if name in logarithmic else F.col(name).cast("double")
        return ((x - low) / (high - low) if high > low else F.lit(0.0)).alias("u")

    order = Window.orderBy("val_mae", "trial")
    known = trials.where("val_mae is not null and not isnan(val_mae)")
    ranked = known.withColumns({"at": F.row_number().over(order), "n": F.count("*").over(Window.partitionBy())})
    ranked = ranked.withColumn("good", F.col("at") <= F.ceil(F.col("n") * GOOD_SHARE))
    ranked = ranked.withColumn("size", F.count("*").over(Window.partitionBy("good")))
    points = ranked.select(
        "good", "size", F.explode(F.array(*(F.struct(F.lit(p).alias("name"), scaled(p)) for p in ranges))).alias("p")
    ).select("good", "size", "p.*")
    places = points.where("good").select(
        "name", F.explode(F.array(*(F.col("u") + kernel_width(F.col("size")) * z for z in OFFSETS))).alias("c")
    )
    places = places.select("name", F.greatest(F.least("c", F.lit(1.0)), F.lit(0.0)).alias("c")).distinct()
    width = kernel_width(F.col("size"))
    kernel = F.exp(-F.pow((F.col("c") - F.col("u")) / width, 2) / 2) / (width * math.sqrt(2 * math.pi))

    def density(good: Column) -> Column:
        return (F.sum(F.when(good, kernel).otherwise(0.0)) + 1) / (F.count_if(good) + 1)

    return places.join(points, "name").groupBy("name", F.col("c").alias("u")).agg(
        density(F.col("good")).alias("good_density"), density(~F.col("good")).alias("other_density")
    )


def suggest(
    trials: DataFrame,
    ranges: dict[str, tuple[float, float]],
    logarithmic: Sequence[str] = (),
    whole: Sequence[str] = (),
    draws: int = 1,
) -> DataFrame:
    """One row per draw with a column for each parameter: of each the `draw`-th best candidate.

    Ties go to the smaller value; with fewer candidates than draws the last ones repeat. No known trial gives no row.
    """
    ratio = F.round(F.ln("good_density") - F.ln("other_density"), 9)
    order = Window.partitionBy("name").orderBy(F.desc("ratio"), "u")
    best = densities(trials, ranges, logarithmic).withColumn("ratio", ratio).withColumn("draw", F.row_number().over(order))
    best = best.where(F.col("draw") <= draws)
    last = best.groupBy("name").agg(F.max_by("u", "draw").alias("last"), F.collect_list(F.struct("draw", "u")).alias("all"))
    wanted = last.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    value = F.coalesce(F.try_element_at(F.map_from_entries("all"), F.col("draw")), F.col("last"))
    wide = wanted.select("name", "draw", value.alias("u")).groupBy("draw")

    def unscaled(name: str) -> Column:
        low, high = ranges[name]
        u = F.max(F.when(F.col("name") == name, F.col("u")))
        if name in logarithmic:
            return F.exp(math.log(low) + u * (math.log(high) - math.log(low))).alias(name)
        x = low + u * (high - low)
        return (F.round(x).cast("int") if name in whole else x).alias(name)

    return wide.agg(*(unscaled(p) for p in ranges)).orderBy("draw")

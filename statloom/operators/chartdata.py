"""The aggregates behind charts: small tables that a plotting tool can draw."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators import profile, ranks
from statloom.operators.ranks import col
from statloom.session import materialise

ROOT_TWO_PI = 2.5066282746310002
FEW_GROUPS = 10_000
CELLS = 128


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin of [low, high]; bins are half open but for the last. A range without width
    puts everything into bin 0; missing values have no bin."""
    width = (high - low) / bins
    place = F.floor((value - low) / F.when(width > 0, width).otherwise(1.0))
    inside = F.greatest(F.lit(0), F.least(F.lit(bins - 1), place))
    return F.when(value.isNotNull() & ~F.isnan(value), inside).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """(column, bin, low, high, n) of equal-width bins, empty ones included; nulls are dropped.

    Bins are counted per column within one scan, at most `bins` rows per column and task are
    shuffled."""
    limits = F.col("__range")
    binned = ranks.attach(df, ranks.extent(df, cols), "__range").select(
        *[
            equal_width_bin(col(c).cast("double"), limits[c]["low"], limits[c]["high"], bins).alias(c)
            for c in cols
        ]
    )
    counts = (
        binned.unpivot([], [col(c) for c in cols], "column", "bin")
        .where("bin IS NOT NULL")
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = ranks.extent(df, cols).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column"), col(c)["low"].alias("lo"), col(c)["high"].alias("hi")) for c in cols]
            )
        )
    )
    every_bin = frame.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    step = (F.col("hi") - F.col("lo")) / bins
    return every_bin.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _box_aggregates(width: float) -> dict[str, Column]:
    value = F.col("value")
    reach = F.lit(width) * (F.col("q3") - F.col("q1"))
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    return {
        "whisker_low": F.min(F.when(inside, value)),
        "whisker_high": F.max(F.when(inside, value)),
        "outliers": F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)),
    }


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), width: float = 1.5) -> DataFrame:
    """(by..., column, q1, median, q3, whisker_low, whisker_high, outliers). Whiskers end at the
    extreme data points within width * IQR of the box."""
    keys = [*by, "column"]
    freq = ranks.frequencies(df, cols, by)
    box = ranks.quantiles(df, cols, profile.QUARTILES, by)
    ends = (
        freq.join(F.broadcast(box) if not by else box, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(*[expr.alias(name) for name, expr in _box_aggregates(width).items()])
    )
    return ends


def density(
    df: DataFrame, value: str, points: int = 50, by: Sequence[str] = (), cut: float = 0.0
) -> DataFrame:
    """Gaussian kernel density on an even grid over [min - cut*h, max + cut*h] with Scott's
    bandwidth h = s * n^(-1/5): (by..., point, x, density).

    Rows are first summed into cells of a CELLS-th of the bandwidth: each gives its four nearest cell edges
    the weights of cubic interpolation, which keeps the kernel sums to about nine digits. Only cells
    are shuffled, and kernels are computed for cells, not for rows. Up to FEW_GROUPS groups, which are
    counted first, bandwidths are sent to the rows.
    """
    numbers = df.select(*[col(b) for b in by], col(value).cast("double").alias("__v")).where(
        "__v IS NOT NULL AND NOT isnan(__v)"
    )
    for b in by:
        numbers = numbers.where(col(b).isNotNull())
    stats = numbers.groupBy(*by).agg(
        F.count("__v").alias("__n"),
        F.min("__v").alias("__lo"),
        F.max("__v").alias("__hi"),
        (F.stddev_samp("__v") * F.pow(F.count("__v"), F.lit(-0.2))).alias("__h"),
    ).where("__h > 0")
    if by:
        stats = materialise(stats, "bandwidths")
        joined = numbers.join(F.broadcast(stats) if stats.count() <= FEW_GROUPS else stats, list(by))
    else:
        joined = ranks.attach(numbers, stats).select("__v", "__stats.*").where("__h > 0")
    low = F.col("__lo") - cut * F.col("__h")
    step = (F.col("__hi") - F.col("__lo") + 2 * cut * F.col("__h")) / (points - 1)
    shape = joined.withColumn("__low", low).withColumn("__step", step)
    place = (F.col("__v") - F.col("__lo")) * CELLS / F.col("__h")
    w = F.col("__w")
    weights = [-w * (w - 1) * (w - 2) / 6, (w + 1) * (w - 1) * (w - 2) / 2, -(w + 1) * w * (w - 2) / 2, (w + 1) * w * (w - 1) / 6]
    frame = ["__n", "__h", "__lo", "__low", "__step"]
    cells = (
        shape.withColumn("__cell", F.floor(place))
        .withColumn("__w", place - F.col("__cell"))
        .groupBy(*by, *frame, "__cell")
        .agg(F.array(*[F.sum(x) for x in weights]).alias("__weights"))
        .select(*by, *frame, "__cell", F.posexplode("__weights").alias("__edge", "__weight"))
        .withColumn("__v", F.col("__lo") + (F.col("__cell") + F.col("__edge") - 1) * F.col("__h") / CELLS)
    )
    kernels = [
        F.expr(f"sum(__weight * exp(-0.5D * pow((__low + {i} * __step - __v) / __h, 2))) AS k{i}")
        for i in range(points)
    ]
    sums = cells.groupBy(*by, "__n", "__h", "__low", "__step").agg(*kernels)
    curve = sums.select(
        *by, "__n", "__h", "__low", "__step", F.array(*[f"k{i}" for i in range(points)]).alias("k")
    ).select(*by, "__n", "__h", "__low", "__step", F.posexplode("k").alias("point", "k"))
    return curve.select(
        *by,
        "point",
        (F.col("__low") + F.col("point") * F.col("__step")).alias("x"),
        (F.col("k") / (F.col("__n") * F.col("__h") * ROOT_TWO_PI)).alias("density"),
    )


def pair_bins(
    df: DataFrame, cols: Sequence[str], label: str, bins: int = 10
) -> DataFrame:
    """Pair plot as counts: (x, y, label, x_bin, y_bin, n) for every pair of columns. A task ships
    at most one row per pair, label and occupied cell."""
    limits = F.col("__range")
    binned = ranks.attach(df, ranks.extent(df, cols), "__range").select(
        col(label),
        *[
            equal_width_bin(col(c).cast("double"), limits[c]["low"], limits[c]["high"], bins).alias(f"__{c}")
            for c in cols
        ],
    )
    # A pair's two bins travel as one number, so the pairs are an unpivot over plain columns.
    pairs = list(combinations(cols, 2))
    joint = binned.select(
        col(label),
        *[(col(f"__{x}") * bins + col(f"__{y}")).alias(f"{i}") for i, (x, y) in enumerate(pairs)],
    )
    counts = (
        joint.unpivot([col(label)], [col(f"{i}") for i in range(len(pairs))], "pair", "cell")
        .where("cell IS NOT NULL")
        .groupBy("pair", col(label), "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    at = F.col("pair").cast("int")
    return counts.select(
        F.element_at(F.array(*[F.lit(x) for x, _ in pairs]), at + 1).alias("x"),
        F.element_at(F.array(*[F.lit(y) for _, y in pairs]), at + 1).alias("y"),
        col(label),
        F.floor(F.col("cell") / bins).cast("int").alias("x_bin"),
        (F.col("cell") % bins).alias("y_bin"),
        "n",
    )


def scatter_top_two(df: DataFrame, target: str, cols: Sequence[str], bins: int = 25) -> DataFrame:
    """Scatter of the two columns most correlated with the target, by target value. Which two is
    known only at run time, so the ranking is taken first: two names reach the driver. Points are
    counted per cell, as a plot of all rows has no bound."""
    top = [r["column"] for r in profile.top_correlated(df, target, cols, 2).collect()]
    return pair_bins(df, sorted(top), target, bins)

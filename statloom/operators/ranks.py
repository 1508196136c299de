"""Order statistics that never put a whole column, or a whole group, into one task.

Values are counted by 256ths of an octave with map-side combining; only the cells that hold a wanted
rank are counted again, by further bits of an order-preserving 64-bit integer, the bits of the double,
until such a cell holds one value or few rows, and then its values are ranked. How the
values lie makes no difference: an offset, an outlier or an infinity costs another round at most.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.session import materialise, shared_dir

# A first cell has about the sign, the exponent and eight bits of the mantissa in common; each round
# looks at twelve more bits.
LEADING_SHIFT, ROUND_BITS = 44, 12
OPEN_ROWS = 10_000
SMALLEST_NORMAL = 2.0**-1022
# Beyond this many ranks a condition written out for each would be more than Spark compiles.
MANY_RANKS = 16


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def observed(df: DataFrame, name: str) -> Column:
    """A column with NaN turned into null."""
    kind = df.schema[name].dataType
    return F.when(~F.isnan(col(name)), col(name)) if isinstance(kind, (T.DoubleType, T.FloatType)) else col(name)


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) of the numeric columns, missing values left out."""
    typed = df.select(*[col(b) for b in by], *[col(c).cast("double").alias(c) for c in cols])
    if len(cols) == 1:
        long = typed.select(*[col(b) for b in by], F.lit(cols[0]).alias("column"), col(cols[0]).alias("value"))
    else:
        long = typed.unpivot([col(b) for b in by], [col(c) for c in cols], "column", "value")
    present = F.col("value").isNotNull() & ~F.isnan("value")
    for b in by:
        present = present & col(b).isNotNull()
    return long.where(present)


def frequencies(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, n): one row per distinct value."""
    return long_values(df, cols, by).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def sortable(value: Column) -> Column:
    """The bits of a double as an integer in the order of the doubles; both zeros are 0."""
    size = F.abs(value)
    power = F.least(F.floor(F.log2(size)), F.lit(1023))
    ratio = size / F.pow(F.lit(2.0), power.cast("double"))
    # The logarithm may be off by one next to a power of two.
    power = F.when(ratio < 1, power - 1).when(ratio >= 2, power + 1).otherwise(power)
    ratio = F.when(ratio < 1, ratio * 2).when(ratio >= 2, ratio / 2).otherwise(ratio)
    normal = F.shiftleft((power + 1023).cast("bigint"), 52) + ((ratio - 1) * 2.0**52).cast("bigint")
    bits = (
        F.when(size < SMALLEST_NORMAL, (size * 2.0**537 * 2.0**537).cast("bigint"))
        .when(size == float("inf"), F.lit(2047 << 52))
        .otherwise(normal)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def extent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: a struct (low, high) per column."""
    return df.agg(
        *[
            F.struct(
                F.min(observed(df, c).cast("double")).alias("low"), F.max(observed(df, c).cast("double")).alias("high")
            ).alias(c)
            for c in cols
        ]
    )


def leading(value: Column) -> Column:
    """A number in the order of the doubles, one for each 256th of an octave: about what the leading bits
    tell, for less work. Zero is 0 and infinities are beyond all others."""
    size = F.abs(value)
    octaves = F.floor(F.log2(size) * 256) + 1075 * 256 + 1
    return F.signum(value).cast("bigint") * F.when(size == 0, 0).when(size == float("inf"), 1 << 40).otherwise(octaves)


Ranks = Callable[[Column], list[Column]]
"""The wanted 0-based ranks, from the number of values."""


def quantile_ranks(probs: dict[str, float]) -> Ranks:
    def wanted(n_total: Column) -> list[Column]:
        places = [F.lit(float(p)) * (n_total - 1) for p in probs.values()]
        return [rank for place in places for rank in (F.floor(place), F.ceil(place))]

    return wanted


def counted(rows: DataFrame, keys: Sequence[str], cell: Column) -> DataFrame:
    """Counts of (keys..., value, n) by cell."""
    return rows.groupBy(*keys, cell.alias("cell")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("value").alias("least"), F.max("value").alias("most")
    )


def holding(counts: DataFrame, keys: Sequence[str], order: str, ranks: Ranks) -> DataFrame:
    """The rows of `counts` that hold a wanted rank, with `start`: how many values come before.

    Parents bring `before` and `n_total`; without parents the keys' own totals are taken.
    """
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    running = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if "n_total" not in counts.columns:
        counts = counts.withColumns({"n_total": F.sum("n").over(whole), "before": F.lit(0).cast("bigint")})
    placed = counts.withColumn("start", F.col("before") + F.sum("n").over(running) - F.col("n"))
    inside = lambda rank: (rank >= F.col("start")) & (rank < F.col("start") + F.col("n"))
    wanted = ranks(F.col("n_total"))
    if len(wanted) > MANY_RANKS:
        return placed.where(F.exists(F.array(*wanted), inside))
    return placed.where(reduce(lambda a, b: a | b, map(inside, wanted)))


Step = tuple[int, int, float]
"""Ranks from, ranks to (exclusive), value."""


def order_statistics(rows: DataFrame, keys: Sequence[str], ranks: Ranks) -> dict[tuple, tuple[int, list[Step]]]:
    """For each key the number of values and the steps that hold the wanted ranks, of (keys..., value,
    n), where values may repeat. For a number of keys that the caller has bounded: a few rows per
    key and rank reach the driver. Whole columns take one scan if wanted values repeat, as a rule two.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("number", sortable(F.col("value")))
    kinds = [rows.schema[k] for k in keys]
    out: dict[tuple, tuple[int, list[Step]]] = {}
    counts, parents, shift, opened = counted(rows, keys, leading(F.col("value"))), [*keys], LEADING_SHIFT, []

    def note(row, value: float) -> None:
        _, steps = out.setdefault(tuple(row[k] for k in keys), (row["n_total"], []))
        steps.append((row["start"], row["start"] + row["n"], value))

    def below(found: list) -> DataFrame:
        """The rows within found cells; each cell is a `part`."""
        fields = [*kinds, *[T.StructField(c, T.LongType()) for c in ("part", "before", "n_total")]]
        fields += [T.StructField(c, T.DoubleType()) for c in ("low", "high")]
        cells = [(*[r[k] for k in keys], i, r["start"], r["n_total"], r["least"], r["most"]) for i, r in enumerate(found)]
        table = F.broadcast(spark.createDataFrame(cells, T.StructType(fields)))
        joined = rows.join(table, list(keys)) if keys else rows.crossJoin(table)
        return joined.where("value between low and high")

    while True:
        crowded = []
        for row in holding(counts, parents, "cell", ranks).collect():
            if row["least"] == row["most"]:
                note(row, row["least"])
            else:
                (crowded if row["rows"] > OPEN_ROWS else opened).append(row)
        if not crowded:
            break
        shift = max(shift - ROUND_BITS, 0)
        parents = [*keys, "part", "before", "n_total"]
        counts = counted(below(crowded), parents, F.shiftright("number", shift))
    if opened:
        parents = [*keys, "part", "before", "n_total"]
        values = below(opened).groupBy(*parents, "value").agg(F.sum("n").alias("n"))
        for row in holding(values, parents, "value", ranks).collect():
            note(row, row["value"])
    return out


def at_rank(steps: Sequence[Step], rank: int) -> float:
    return next(value for start, stop, value in steps if start <= rank < stop)


def interpolated(n_total: int, steps: Sequence[Step], prob: float) -> float:
    place = float(prob) * (n_total - 1)
    low, high = at_rank(steps, floor(place)), at_rank(steps, ceil(place))
    return low if low == high else low + (place - floor(place)) * (high - low)


def few_quantiles(rows: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation of (keys..., value, n), computed now: one row per key
    and one column per entry of `probs`."""
    found = order_statistics(rows, keys, quantile_ranks(probs))
    data = [(*key, *[interpolated(n, steps, p) for p in probs.values()]) for key, (n, steps) in found.items()]
    fields = [*[rows.schema[k] for k in keys], *[T.StructField(p, T.DoubleType()) for p in probs]]
    return rows.sparkSession.createDataFrame(data, T.StructType(fields))


def many_quantiles(freq: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """`few_quantiles` for any number of keys, of (keys..., value, n) with distinct values per key. Found
    cells stay tables and are joined; a key that holds most rows is spread, as the values are."""
    kept = materialise(freq.withColumn("number", sortable(F.col("value"))), "values")
    ranks, shift, opened = quantile_ranks(probs), LEADING_SHIFT, []
    counts, parents = counted(kept, keys, F.shiftright("number", shift)), [*keys]
    crowded = (F.col("least") < F.col("most")) & (F.col("rows") > OPEN_ROWS)
    while True:
        found = materialise(holding(counts, parents, "cell", ranks), "cells")
        cells = found.select(*keys, F.col("cell").alias("part"), F.col("start").alias("before"), "n_total", "least", "most", "rows")
        placed = kept.withColumn("part", F.shiftright("number", shift))
        parents = [*keys, "part", "before", "n_total"]
        opened.append(placed.join(cells.where(~crowded).drop("least", "most", "rows"), [*keys, "part"]).select(*parents, "value", "n"))
        if cells.where(crowded).isEmpty():
            break
        shift = max(shift - ROUND_BITS, 0)
        inside = placed.join(cells.where(crowded).drop("least", "most", "rows"), [*keys, "part"])
        counts = counted(inside, parents, F.shiftright("number", shift))
    values = opened[0]
    for more in opened[1:]:
        values = values.union(more)
    steps = holding(values, parents, "value", ranks)
    places = {name: F.lit(float(p)) * (F.col("n_total") - 1) for name, p in probs.items()}

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("start") + F.col("n")), F.col("value")))

    ends = steps.groupBy(*keys, "n_total").agg(
        *[at(F.floor(p)).alias(f"{name}__lo") for name, p in places.items()],
        *[at(F.ceil(p)).alias(f"{name}__hi") for name, p in places.items()],
    )

    def between(name: str, place: Column) -> Column:
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        return F.when(low == high, low).otherwise(low + (place - F.floor(place)) * (high - low))

    return ends.select(*keys, *[between(name, p).alias(name) for name, p in places.items()])


def running_totals(freq: DataFrame, weights: Sequence[str]) -> DataFrame:
    """(value, weights...) of distinct values, with `<w>_before` and `<w>_total`: sums over all smaller
    values and over all. Values are dealt by ranges, however they lie; of each range one row of
    sums is carried to the next."""
    ranged = freq.repartitionByRange("value").withColumn("__part", F.spark_partition_id())
    placed = materialise(ranged, "ranges")
    sums = placed.groupBy("__part").agg(*[F.sum(w).alias(w) for w in weights])
    parts = Window.orderBy("__part")
    earlier, whole = parts.rowsBetween(Window.unboundedPreceding, -1), parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select(
        "__part",
        *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"{w}_earlier") for w in weights],
        *[F.sum(w).over(whole).alias(f"{w}_total") for w in weights],
    )
    inside = Window.partitionBy("__part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = placed.join(F.broadcast(offsets), "__part")
    return joined.select(
        *freq.columns,
        *[(F.col(f"{w}_earlier") + F.sum(w).over(inside) - F.col(w)).alias(f"{w}_before") for w in weights],
        *[F.col(f"{w}_total") for w in weights],
    )


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: dict[str, float],
    by: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """(by..., column, <one column per quantile>), exact and computed now.

    Without groups, or with a number of groups the caller has bounded, no row-sized shuffle takes
    place. With unbounded groups the values are counted once per group and distinct value, a shuffle
    whose key contains the value and therefore spreads a dominating group.
    """
    keys = [*by, "column"]
    if by and not few_groups:
        return many_quantiles(frequencies(df, cols, by), keys, probs)
    return few_quantiles(long_values(df, cols, by).withColumn("n", F.lit(1).cast("bigint")), keys, probs)


def quantile_row(df: DataFrame, cols: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """One row holding a struct of quantiles per column, to be read as a scalar subquery."""
    return as_row(quantiles(df, cols, probs), cols, list(probs))


def as_row(per_column: DataFrame, cols: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Turn (column, stat...) into one row with a struct of the stats per column."""
    return per_column.agg(
        *[
            F.struct(
                *[F.max(F.when(F.col("column") == c, F.col(s))).alias(s) for s in stats]
            ).alias(c)
            for c in cols
        ]
    )


def modes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, mode): most frequent value, the smallest on ties."""
    return frequency_modes(frequencies(df, cols, by), [*by, "column"])


def frequency_modes(freq: DataFrame, keys: Sequence[str]) -> DataFrame:
    return freq.groupBy(*keys).agg(
        F.min_by("value", F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("mode")
    )


def attach(df: DataFrame, one_row: DataFrame, name: str = "__stats") -> DataFrame:
    """Add a one-row table to every row as a struct column. It is a scalar subquery: Spark computes
    the row once and uses it like a literal, so the table itself is neither joined nor shuffled.
    Keeping it as one column also keeps it a single subquery, however often it is read."""
    return df.withColumn(name, one_row.select(F.struct(*[col(c) for c in one_row.columns])).scalar())


def fixed(one_row: DataFrame) -> DataFrame:
    """Compute a one-row table now. For chains whose statistics build on each other: nested
    subqueries would plan and run the earlier ones again inside every later one."""
    return one_row.sparkSession.createDataFrame([one_row.first()], one_row.schema)


def positional_index(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """Number the rows 0..n-1 in the given order without a single-partition window.

    The sorted rows are checkpointed with their place inside their partition, which fixes the
    partition bounds; the offsets are then one row per partition.
    """
    shared_dir(df.sparkSession)
    placed = df.orderBy(*order_by).withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__id", 33)
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__off"))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, (F.col("__off") + place).cast("bigint"))
        .drop("__id", "__part", "__off")
    )

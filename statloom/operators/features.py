"""Splitting, scaling, encoding and projection of features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import floor

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.scalar import mapped
from statloom.operators import clean, linear, profile, ranks
from statloom.operators.ranks import attach, col

# Up to this many categories a label encoder is an expression, beyond it a join.
MAX_CATEGORIES = 256
MAX_LABELS = 256
# Up to this many categories a one-hot encoding may be a column each.
MAX_FLAGS = 4096


def key_hash(key: Column, seed: str = "", digits: int = 8) -> Column:
    """Number from the first hex digits of the key's MD5: the same under any partitioning."""
    text = F.concat(key.cast("string"), F.lit(seed)) if seed else key.cast("string")
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def in_test(key: Column, share: float = 0.2, seed: str = "") -> Column:
    """Whether a row belongs to the held-out share, decided by its key alone."""
    return key_hash(key, seed) % 100 < F.lit(int(round(share * 100)))


def random_split(df: DataFrame, key: str, share: float = 0.2, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash, without a shuffle."""
    held_out = in_test(col(key), share, seed)
    return df.where(~held_out), df.where(held_out)


def stratified_flag(
    df: DataFrame, label: str, key: str, share: float = 0.2, name: str = "is_test"
) -> DataFrame:
    """Adds a flag that marks, per label, exactly round(share * n) rows: those with the smallest
    key hashes.

    The hash of the last marked row is an order statistic of each label, found by counting, so even a
    label with most of the rows is neither sorted nor gathered. Up to MAX_LABELS labels, the cuts
    are literals and no row is shuffled; beyond, they are a table that is joined.
    """
    number = key_hash(col(key), digits=13)
    hashed = df.where(col(label).isNotNull()).select(col(label).alias("__label"), number.cast("double").alias("value"), col(key).alias("__key"))
    counts = hashed.withColumn("n", F.lit(1).cast("bigint"))
    few = len(hashed.select("__label").distinct().take(MAX_LABELS + 1)) <= MAX_LABELS
    if few:
        last = lambda n_total: [F.floor(F.lit(share) * n_total + 0.5) - 1]
        found = ranks.order_statistics(counts, ["__label"], last)
        cuts = {k: (v, n, int(floor(share * total + 0.5))) for (k,), (total, steps) in found.items() for n, _, v in steps}
        fields = [hashed.schema["__label"], T.StructField("__cut", T.DoubleType()), T.StructField("__left", T.LongType())]
        # Rows that share the hash of the last one are taken by key, as far as the share goes.
        edges = df.sparkSession.createDataFrame([(k, v, wanted - n) for k, (v, n, wanted) in cuts.items()], T.StructType(fields))
        tied = hashed.join(F.broadcast(edges), "__label").where("value = __cut")
        place = F.row_number().over(Window.partitionBy("__label").orderBy("__key"))
        keys = {r["__label"]: r["__key"] for r in tied.withColumn("__place", place).where("__place = __left").collect()}
        flag = F.lit(False)
        for k, (v, _, _) in cuts.items():
            within = (number < int(v)) | ((number == int(v)) & (col(key) <= F.lit(keys[k])))
            flag = F.when(col(label) == F.lit(k), within).otherwise(flag)
        return df.withColumn(name, F.coalesce(flag, F.lit(False)))
    sizes = counts.groupBy("__label").agg(F.floor(F.lit(share) * F.sum("n") + 0.5).alias("__wanted"))
    # So many labels are small groups but for a few, and ranked in full.
    place = F.row_number().over(Window.partitionBy("__label").orderBy("value", "__key"))
    cut = hashed.withColumn("__place", place).join(sizes, "__label").where("__place = __wanted")
    cut = cut.select(F.col("__label").alias(label), F.struct("value", "__key").alias("__cut"))
    here = F.struct(number.cast("double").alias("value"), col(key).alias("__key"))
    joined = df.join(cut, label, "left").withColumn(name, F.coalesce(here <= F.col("__cut"), F.lit(False)))
    return joined.select(*[col(c) for c in df.columns], name)


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes zero."""
    basis = df if fit_on is None else fit_on
    stats = basis.agg(
        *[
            F.struct(F.avg(ranks.observed(basis, c)).alias("mean"), F.stddev_pop(ranks.observed(basis, c)).alias("std")).alias(c)
            for c in cols
        ]
    )
    s = F.col("__stats")
    return (
        attach(df, stats)
        .withColumns(
            {
                c: (ranks.observed(df, c) - s[c]["mean"]) / F.when(s[c]["std"] > 0, s[c]["std"]).otherwise(F.lit(1.0))
                for c in cols
            }
        )
        .drop("__stats")
    )


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes zero."""
    s = F.col("__stats")
    return (
        attach(df, ranks.extent(df if fit_on is None else fit_on, cols))
        .withColumns(
            {
                c: (ranks.observed(df, c) - s[c]["low"])
                / F.when(s[c]["high"] > s[c]["low"], s[c]["high"] - s[c]["low"]).otherwise(F.lit(1.0))
                for c in cols
            }
        )
        .drop("__stats")
    )


def fit_categories(df: DataFrame, cols: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str] | None]:
    """Categories of each column as text, in the order of the values themselves, or None where there
    are more than `limit`. The number of categories is estimated first with fixed-size sketches, so
    only small sets are ever built."""
    if not cols:
        return {}
    estimates = df.agg(*[F.approx_count_distinct(col(c)).alias(c) for c in cols]).first()
    small = [c for c in cols if estimates[c] <= limit * 1.2]
    found: dict[str, list[str] | None] = dict.fromkeys(cols)
    if small:
        row = df.agg(*[_sorted_texts(c).alias(c) for c in small]).first()
        found.update({c: list(row[c]) for c in small if len(row[c]) <= limit})
    return found


def _sorted_texts(name: str) -> Column:
    return F.transform(F.sort_array(F.collect_set(col(name))), lambda v: v.cast("string"))


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    drop_first: bool = True,
    categories: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Replace each column by 0/1 columns `<column>_<category>`, categories in sorted order, the
    first one dropped. Null has zeros everywhere. There are as many new columns as categories; more than
    MAX_FLAGS are refused, `one_hot_slots` has no bound."""
    known = categories if categories is not None else fit_categories(df, cols, MAX_FLAGS)
    wide = [c for c in cols if known[c] is None]
    if wide:
        raise ValueError(f"more than {MAX_FLAGS} categories, use one_hot_slots: {wide}")
    flags = {
        f"{c}_{v}": F.when(col(c).cast("string") == v, F.lit(1)).otherwise(F.lit(0))
        for c in cols
        for v in list(known[c])[1 if drop_first else 0 :]
    }
    return df.withColumns(flags).drop(*cols) if flags else df.drop(*cols)


def category_index(df: DataFrame, name: str) -> DataFrame:
    """(name, __code): the distinct values numbered from 0 in their own order, by a distributed sort."""
    values = df.select(col(name)).where(col(name).isNotNull()).distinct()
    return ranks.positional_index(values, [name], "__code")


def one_hot_slots(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """One-hot encoding of any number of categories: each column is replaced by `<column>_size`, the
    length of its vector, and `<column>_slot`, the place of its one. The first category, null and
    categories that `fit_on` lacks have no slot: their vector is zero. The categories stay a table,
    which is joined; `one_hot_vectors` makes sparse vectors of the slots."""
    out = df
    for c in cols:
        index = category_index(df if fit_on is None else fit_on, c)
        size = index.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0))).scalar()
        slots = index.select(col(c), F.nullif(F.col("__code") - 1, F.lit(-1)).alias("__slot"))
        out = out.join(slots, c, "left").withColumns({f"{c}_size": size, f"{c}_slot": F.col("__slot")}).drop("__slot")
    kept = [n for c in df.columns for n in ([f"{c}_size", f"{c}_slot"] if c in cols else [c])]
    return out.select(*[col(n) for n in kept])


def one_hot_vectors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace the slots of `one_hot_slots` by sparse vectors `<column>_vector`."""
    sizes = df.agg(*[F.max(col(f"{c}_size")).alias(c) for c in cols]).first()
    for c in cols:
        size = int(sizes[c] or 0)
        # A place behind the last one is what the encoder drops.
        place = F.coalesce(col(f"{c}_slot"), F.lit(size)).cast("double")
        indexed = df.withColumn(f"{c}_slot", place.alias(f"{c}_slot", metadata={"ml_attr": {"type": "nominal", "num_vals": size + 1}}))
        encoder = OneHotEncoder(inputCols=[f"{c}_slot"], outputCols=[f"{c}_vector"], dropLast=True)
        df = encoder.fit(indexed).transform(indexed).drop(f"{c}_slot", f"{c}_size")
    return df


def label_encode(
    df: DataFrame, cols: Sequence[str], categories: Mapping[str, Sequence[str] | None] | None = None
) -> DataFrame:
    """Replace each column by the 0-based rank of its value among the distinct values in their own
    order; null stays null. Small category sets become an expression. For larger ones the distinct
    values are numbered by a distributed sort and joined; the codes are the same."""
    known = categories if categories is not None else fit_categories(df, cols)
    out = df
    for c in cols:
        if known[c] is not None:
            place = F.array_position(F.array(*[F.lit(v) for v in known[c]]), col(c).cast("string"))
            out = out.withColumn(c, F.when(place > 0, place - 1).cast("bigint"))
        else:
            codes = category_index(df, c)
            out = out.join(codes, c, "left").withColumn(c, F.col("__code")).drop("__code")
    return out.select(*[col(c) for c in df.columns])


def interaction(df: DataFrame, a: str, b: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{a}_{b}_interaction", col(a) * col(b))


def log_transform(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(f"{name}_log", F.log1p(col(name)))


def column_transform(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    keep: Sequence[str] = (),
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Scaled numeric and one-hot categorical columns next to `keep`; all other columns are
    dropped. Means, deviations and categories are those of `fit_on`; a category that it lacks has
    zeros everywhere."""
    basis = df if fit_on is None else fit_on
    picked = df.select(*[col(c) for c in [*keep, *numeric, *categorical]])
    return one_hot(standard_scale(picked, numeric, basis), categorical, True, fit_categories(basis, categorical, MAX_FLAGS))


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], output: str = "features") -> Pipeline:
    """The same preparation as stages of a saved model. The category index is in descending order
    so that the encoder drops the alphabetically first category."""
    indexed = [f"__{c}_index" for c in categorical]
    encoded = [f"__{c}_vector" for c in categorical]
    stages = [
        VectorAssembler(inputCols=list(numeric), outputCol="__numeric"),
        StandardScaler(inputCol="__numeric", outputCol="__scaled", withMean=True, withStd=True),
    ]
    if categorical:
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=indexed, stringOrderType="alphabetDesc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=["__scaled", *encoded], outputCol=output))
    return Pipeline(stages=stages)


def encode_table(
    df: DataFrame,
    target: str,
    target_codes: Mapping[str, int],
    sentinel: str = "?",
    threshold: int = 5,
) -> DataFrame:
    """Preparation chain of a mixed table: trim strings, sentinel to null, mode fill, one-hot for
    columns below `threshold` categories and label codes for the others, target mapping."""
    strings = profile.columns_by_type(df, "string")
    others = [c for c in strings if c != target]
    cleaned = (
        df.transform(clean.trim_strings, strings)
        .transform(clean.sentinel_to_null, strings, sentinel)
    )
    filled = clean.fill_mode(cleaned, others, fit_on=cleaned)
    known = fit_categories(filled, others)
    low = [c for c in others if known[c] is not None and len(known[c]) < threshold]
    high = [c for c in others if c not in low]
    return (
        filled.transform(one_hot, low, True, known)
        .transform(label_encode, high, known)
        .withColumn(target, mapped(col(target), target_codes))
    )


@dataclass(frozen=True)
class Projection:
    """Fitted principal components: `loadings` has one row per component."""

    cols: tuple[str, ...]
    mean: np.ndarray
    scale: np.ndarray
    loadings: np.ndarray
    variance: np.ndarray

    def columns(self, prefix: str = "pc") -> list[Column]:
        """The components as column expressions, so projecting stays inside the JVM. Each is an
        inner product of two arrays: a sum written out over many columns would burden the
        optimizer."""
        x = F.array(*[col(c).cast("double") for c in self.cols])
        out = []
        for k, weights in enumerate(self.loadings / self.scale):
            w = F.array(*[F.lit(float(v)) for v in weights])
            dot = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
            out.append((dot - F.lit(float(weights @ self.mean))).alias(f"{prefix}{k + 1}"))
        return out


def fit_pca(df: DataFrame, cols: Sequence[str], k: int = 2, standardise: bool = True) -> Projection:
    """Principal components of centred, by default standardised, columns. Only the moment matrix
    reaches the driver. Each component is signed so that its largest loading is positive."""
    m = linear.fit_moments(df, cols)[()]
    scale = np.sqrt(np.diag(m.cov)) if standardise else np.ones(len(cols))
    scale = np.where(scale > 0, scale, 1.0)
    values, vectors = np.linalg.eigh(m.cov / np.outer(scale, scale))
    order = np.argsort(values)[::-1][:k]
    loadings = vectors[:, order].T
    signs = np.sign(loadings[np.arange(len(order)), np.abs(loadings).argmax(axis=1)])
    unbiased = m.n / (m.n - 1) if m.n > 1 else 1.0
    return Projection(tuple(cols), m.mean, scale, loadings * signs[:, None], values[order] * unbiased)

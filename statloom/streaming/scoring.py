"""Scoring of a saved pipeline against an input contract, on batches and on streams.

The pipeline carries everything it learned: fill values, scaling and coefficients. Rows are scored
one by one without state, so the same function serves a batch and a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators import ranks, stages
from statloom.operators.ranks import col

PROBABILITY = "__p1"


@dataclass(frozen=True)
class Field:
    """One input: bounds are inclusive. An absent value takes the default; without one it stays absent,
    and the imputer of the pipeline fills it."""

    name: str
    low: float
    high: float
    default: float | None = None
    dtype: str = "double"

    def value(self) -> Column:
        typed = col(self.name).try_cast(self.dtype)
        return typed if self.default is None else F.coalesce(typed, F.lit(self.default).cast(self.dtype))

    def problem(self) -> Column:
        """Why the input is unfit, or null."""
        given = col(self.name)
        typed = given.try_cast(self.dtype)
        number = typed.cast("double")
        return (
            F.when(given.isNotNull() & typed.isNull(), F.lit(f"{self.name}: not {self.dtype}"))
            .when((number < self.low) | F.isnan(number), F.lit(f"{self.name}: below {self.low:g}"))
            .when(number > self.high, F.lit(f"{self.name}: above {self.high:g}"))
        )


Contract = Sequence[Field]


def checked(df: DataFrame, contract: Contract) -> DataFrame:
    """Adds `problems`, the list of violations of each row."""
    found = F.array_compact(F.array(*[f.problem() for f in contract]))
    return df.withColumn("problems", found)


def accepted(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that satisfy the contract, typed and with defaults filled in."""
    good = checked(df, contract).where(F.size("problems") == 0).drop("problems")
    return good.withColumns({f.name: f.value() for f in contract})


def rejects(df: DataFrame, contract: Contract) -> DataFrame:
    return checked(df, contract).where(F.size("problems") > 0)


def train_pipeline(df: DataFrame, cols: Sequence[str], label: str, c: float = 1.0) -> PipelineModel:
    """Median fill, population-scaled features and a logistic model as one saveable pipeline. The
    medians are exact and travel as literals of the first stage."""
    med = ranks.quantile_row(df, cols, {"median": 0.5}).first()
    filled = ", ".join(
        f"coalesce(CAST(`{k}` AS DOUBLE), {med[k]['median']!r}D) AS `__{k}`" for k in cols
    )
    inputs = [f"__{k}" for k in cols]
    plan = [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        stages.PopulationScaler(inputs),
        stages.NewtonLogistic(inputs, label, PROBABILITY, c),
    ]
    return Pipeline(stages=plan).fit(df.where(col(label).isNotNull()))


def score(df: DataFrame, model: PipelineModel, contract: Contract, keys: Sequence[str]) -> DataFrame:
    """(keys..., probability, percent, predicted, risk) of the accepted rows. Works on a batch and
    on a stream alike."""
    scored = model.transform(accepted(df, contract))
    p = F.col(PROBABILITY)
    high = p >= 0.5
    return scored.select(
        *[col(k) for k in keys],
        p.alias("p1"),
        F.printf(F.lit("%.1f%%"), p * 100).alias("percent"),
        F.when(high, 1).otherwise(0).alias("predicted"),
        F.when(high, "High risk").otherwise("Low risk").alias("risk"),
    )


def score_stream(
    stream: DataFrame,
    model: PipelineModel,
    contract: Contract,
    keys: Sequence[str],
    output: str,
    reject_output: str,
    checkpoint: str,
):
    """Score all files that are available and stop. Each micro-batch is written to two folders
    named after its number, so that a batch replayed after a failure overwrites its own files."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            score(batch, model, contract, keys).write.mode("overwrite").parquet(f"{output}/batch={number}")
            rejects(batch, contract).write.mode("overwrite").parquet(f"{reject_output}/batch={number}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

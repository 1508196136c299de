"""Stages of our own for pipelines that are saved and loaded: an interaction, scaling by the population
deviation, flags for categories, and a logistic model. What a stage has learnt is a parameter, so it is saved with it.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators import classify, features, ranks
from statloom.operators.ranks import col


class Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Keyword arguments are parameters; `None` leaves one unset, as loading does."""

    def _given(self, **values) -> None:
        self._set(**{name: value for name, value in values.items() if value is not None})


class Interaction(Transformer, HasInputCols, HasOutputCol, Stage):
    """The product of the input columns; null where one of them is."""

    def __init__(self, inputCols: list[str] | None = None, outputCol: str | None = None):
        super().__init__()
        self._given(inputCols=inputCols, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        product = F.lit(1.0)
        for name in self.getInputCols():
            product = product * col(name)
        return dataset.withColumn(self.getOutputCol(), product)


class PopulationScaler(Estimator, HasInputCols, Stage):
    """Learns mean and population deviation of the input columns; NaN and null are missing."""

    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._given(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        names = self.getInputCols()
        stats = [fn(ranks.observed(dataset, c)) for c in names for fn in (F.avg, F.stddev_pop)]
        row = [float(v) if v is not None else 0.0 for v in dataset.agg(*[s.alias(f"s{i}") for i, s in enumerate(stats)]).first()]
        return PopulationScalerModel(names, row[::2], [v if v > 0 else 1.0 for v in row[1::2]])


class PopulationScalerModel(Model, HasInputCols, Stage):
    """(x - mean) / deviation in place; a column that was constant becomes 0."""

    means = Param(Params._dummy(), "means", "mean of each column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation of each column", TypeConverters.toListFloat)

    def __init__(self, inputCols: list[str] | None = None, means: list[float] | None = None, deviations: list[float] | None = None):
        super().__init__()
        self._given(inputCols=inputCols, means=means, deviations=deviations)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learnt = zip(self.getInputCols(), self.getOrDefault(self.means), self.getOrDefault(self.deviations))
        return dataset.withColumns({c: (ranks.observed(dataset, c) - F.lit(m)) / F.lit(s) for c, m, s in learnt})


class CategoryFlags(Estimator, HasInputCol, Stage):
    """Learns the categories of a column, in the order of its values; more than features.MAX_FLAGS raise."""

    def __init__(self, inputCol: str | None = None):
        super().__init__()
        self._given(inputCol=inputCol)

    def _fit(self, dataset: DataFrame) -> CategoryFlagsModel:
        name = self.getInputCol()
        known = features.fit_categories(dataset, [name], features.MAX_FLAGS)[name]
        if known is None:
            raise ValueError(f"more than {features.MAX_FLAGS} categories in {name}")
        return CategoryFlagsModel(name, known)


class CategoryFlagsModel(Model, HasInputCol, Stage):
    """0/1 columns `<column>_<category>` but for the first category; null and unseen values are zeros."""

    categories = Param(Params._dummy(), "categories", "known categories in order", TypeConverters.toListString)

    def __init__(self, inputCol: str | None = None, categories: list[str] | None = None):
        super().__init__()
        self._given(inputCol=inputCol, categories=categories)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getInputCol()
        return features.one_hot(dataset, [name], categories={name: self.getOrDefault(self.categories)})


class NewtonLogistic(Estimator, HasInputCols, HasLabelCol, HasOutputCol, Stage):
    """Logistic regression by Newton's method, see `classify.fit_logistic`; `c` is the inverse penalty."""

    c = Param(Params._dummy(), "c", "inverse of the penalty", TypeConverters.toFloat)

    def __init__(self, inputCols: list[str] | None = None, labelCol: str | None = None, outputCol: str | None = None, c: float | None = None):
        super().__init__()
        self._setDefault(c=1.0)
        self._given(inputCols=inputCols, labelCol=labelCol, outputCol=outputCol, c=c)

    def _fit(self, dataset: DataFrame) -> NewtonLogisticModel:
        fit = classify.fit_logistic(dataset, self.getInputCols(), self.getLabelCol(), self.getOrDefault(self.c))
        return NewtonLogisticModel(self.getInputCols(), self.getOutputCol(), fit.intercept, [float(w) for w in fit.coef])


class NewtonLogisticModel(Model, HasInputCols, HasOutputCol, Stage):
    """Adds the probability of class 1, a column expression; null where an input is."""

    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    weights = Param(Params._dummy(), "weights", "coefficient of each column", TypeConverters.toListFloat)

    def __init__(self, inputCols: list[str] | None = None, outputCol: str | None = None, intercept: float | None = None, weights: list[float] | None = None):
        super().__init__()
        self._given(inputCols=inputCols, outputCol=outputCol, intercept=intercept, weights=weights)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fit = classify.LogisticFit(tuple(self.getInputCols()), self.getOrDefault(self.intercept), np.array(self.getOrDefault(self.weights)), 0)
        return dataset.withColumn(self.getOutputCol(), fit.probability())

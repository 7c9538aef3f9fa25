"""Forecasts that need no training: both are features of the row already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.spec import DemandSpec


def seasonal_naive(spec: DemandSpec = DemandSpec()) -> Column:
    """The value one season ago: the longest lag."""
    return F.col(spec.lag_name(max(spec.lags))).cast("double")


def rolling_average(spec: DemandSpec = DemandSpec()) -> Column:
    """The mean of the longest rolling window."""
    return F.col(spec.rolling_name(max(spec.windows)))


def naive_column() -> str:
    return "pred_naive"


def rolling_column(spec: DemandSpec = DemandSpec()) -> str:
    return spec.rolling_name(max(spec.windows)).replace("rolling_mean", "pred_rolling_avg")


def with_baselines(df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    return df.withColumns({naive_column(): seasonal_naive(spec), rolling_column(spec): rolling_average(spec)})


def baseline_predictions(test: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Prediction table with the two baselines only."""
    return with_baselines(test, spec).select(*spec.keys, spec.target, naive_column(), rolling_column(spec))

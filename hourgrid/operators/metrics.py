"""Forecast errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.spec import DemandSpec


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def rmse(actual: Column, predicted: Column) -> Column:
    error = actual - predicted
    return F.sqrt(F.avg(error * error))


def evaluate(df: DataFrame, prediction: str, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: MAE and RMSE of one prediction column."""
    actual, predicted = F.col(spec.target).cast("double"), F.col(prediction).cast("double")
    return df.agg(mae(actual, predicted).alias("mae"), rmse(actual, predicted).alias("rmse"))


def compare_models(
    predictions: DataFrame, columns: Sequence[str], by: Sequence[str] = (), spec: DemandSpec = DemandSpec()
) -> DataFrame:
    """Errors per model, best first; with `by` also per group, for all groups in one job.

    All models are summed in one pass over the rows as they are; only the summed rows are turned to long form.
    """
    actual = F.col(spec.target).cast("double")
    sums = []
    for column in columns:
        predicted = F.col(column).cast("double")
        sums += [mae(actual, predicted).alias(f"_mae_{column}"), rmse(actual, predicted).alias(f"_rmse_{column}")]
    models = F.array(*(
        F.struct(
            F.lit(column.removeprefix("pred_")).alias("model"),
            F.col(f"_mae_{column}").alias("mae"),
            F.col(f"_rmse_{column}").alias("rmse"),
        )
        for column in columns
    ))
    summed = predictions.groupBy(*by).agg(*sums)
    # No rows without groups still aggregate to one row of nulls: an empty slice has no errors to show.
    return summed.select(*by, F.inline(models)).filter(F.col("mae").isNotNull()).orderBy(*by, "mae", "model")


def by_station(predictions: DataFrame, columns: Sequence[str], spec: DemandSpec = DemandSpec()) -> DataFrame:
    return compare_models(predictions, columns, [spec.name], spec)


def improvement(metrics: DataFrame, model: str, reference: str) -> DataFrame:
    """How much lower the model's MAE is than the reference's, in percent."""

    def of(name: str) -> Column:
        return F.max(F.when(F.col("model") == name, F.col("mae")))

    return metrics.agg(of(model).alias("mae_model"), of(reference).alias("mae_reference")).select(
        F.lit(model).alias("model"),
        F.lit(reference).alias("reference"),
        ((1 - F.try_divide(F.col("mae_model"), F.col("mae_reference"))) * 100).alias("improvement_pct"),
    )

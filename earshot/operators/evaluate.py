"""Error of predictions against ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_cold(predictions: DataFrame) -> DataFrame:
    """Without the rows that hold a NULL or NaN in any column."""
    return predictions.na.drop()


def metrics(
    predictions: DataFrame, label: str = "rating", prediction: str = "prediction"
) -> DataFrame:
    """One row ``n, n_cold, n_eval, rmse`` from one pass.

    ``rmse`` is NULL when no usable row is left.  Cold rows turn into NULL errors,
    which the aggregates skip: filtering them out would push the filter below the
    scoring and score every pair twice.
    """
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    errors = predictions.select(
        (F.col(prediction).isNull() | F.isnan(prediction)).alias("cold"),
        F.nanvl(error, F.lit(None).cast("double")).alias("error"),
    )
    return errors.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("cold").alias("n_cold"),
        F.count("error").alias("n_eval"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
    )


def rmse(
    predictions: DataFrame, label: str = "rating", prediction: str = "prediction"
) -> DataFrame:
    """One row ``n_eval, rmse``."""
    return metrics(predictions, label, prediction).select("n_eval", "rmse")

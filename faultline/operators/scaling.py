"""Zero-mean, unit-variance scaling with population variance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions import literal_arrays as constants


def fit_scaler(df: DataFrame, array: str = "sensors", group: str | None = None) -> dict:
    """``{group: (means, deviations)}``, or one such pair; a constant coordinate keeps deviation 1."""
    keys = [group] if group else []
    rows = (
        df.select(*keys, F.posexplode(array).alias("position", "value"))
        .groupBy(*keys, "position")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))
        .orderBy(*keys, "position")
        .collect()
    )
    scalers: dict = {}
    for row in rows:
        means, deviations = scalers.setdefault(row[group] if group else None, ([], []))
        means.append(row["mean"])
        deviations.append(row["deviation"] or 1.0)
    return scalers if group else scalers[None]


def scale(array: Column, means: list[float], deviations: list[float]) -> Column:
    centred = F.zip_with(array, constants.doubles(means), lambda x, m: x - m)
    return F.zip_with(centred, constants.doubles(deviations), lambda x, d: x / d)


def scale_by_group(array: Column, group: Column, scalers: dict) -> Column:
    """Each row scaled by its group's fitted pair; rows of unknown groups are left as they are."""
    scaled = array
    for key, (means, deviations) in scalers.items():
        scaled = F.when(group == key, scale(array, means, deviations)).otherwise(scaled)
    return scaled

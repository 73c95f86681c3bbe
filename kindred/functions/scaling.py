"""Scalar column expressions; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.schema import MEAN_TOLERANCE, RatingScale


def scale(x: Column, mean: Column, bounds: RatingScale = RatingScale()) -> Column:
    """Room left on the rating scale on the side of ``mean`` where ``x`` lies."""
    return (
        F.when(x > mean, F.lit(bounds.hi) - mean)
        .when(x < mean, mean - F.lit(bounds.lo))
        .otherwise(F.lit(1.0))
    )


def deviation(rating: Column, mean: Column, bounds: RatingScale = RatingScale()) -> Column:
    """Deviation from the mean as a share of the room on that side.

    NULL where there is no room at all, which needs a rating outside the bounds.
    """
    gap = rating - mean
    return F.when(F.abs(gap) < MEAN_TOLERANCE, F.lit(0.0)).otherwise(
        F.try_divide(gap, scale(rating, mean, bounds))
    )


def denormalise(mean: Column, dev: Column, bounds: RatingScale = RatingScale()) -> Column:
    """Turn a normalised deviation back into a rating around ``mean``."""
    return mean + dev * scale(mean + dev, mean, bounds)


def rounded(value: Column, places: int) -> Column:
    """Round half up by plain floating-point steps: floor(x * 10^p + 0.5) / 10^p.

    Unlike ``round`` it does not go through a decimal per row, gives the same double
    in numpy and in other SQL engines, and never yields negative zero.  A double too
    large to have such places (its scaled form is beyond 2**52) is returned as it is.
    """
    unit = F.lit(float(10 ** places))
    steps = F.floor(value * unit + F.lit(0.5)).cast("double") / unit
    return F.when(F.abs(value * unit) < F.lit(float(1 << 52)), steps).otherwise(value)

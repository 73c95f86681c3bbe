"""Memory-based collaborative filtering as Spark DataFrame transformations."""

from kindred.schema import FitSettings, RatingScale
from kindred.session import build_session

__all__ = ["FitSettings", "RatingScale", "build_session"]

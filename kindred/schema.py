"""Column layouts and the settings shared by every operator.

All frames are long format with named columns:

ratings          user_id, item_id, rating
user means       user_id, user_mean, n
item means       item_id, item_mean, n
deviations       user_id, item_id, rating, user_mean, dev
vectors          user_id, item_id, dev, pdev, n_rated, tiled, hot  (operators.vectors)
pairs            user_id < neighbor_id, similarity        (one row per unordered pair)
edges            user_id -> neighbor_id, similarity[, rank]
weighted sums    user_id, item_id, num, den
predictions      user_id, item_id, rating, user_mean, prediction
metrics          model, k, n, mae
"""

from __future__ import annotations

from dataclasses import dataclass

# Similarities are rounded to this many places before anything is ranked, so
# that the last bits of a distributed sum never decide who is a neighbour.
SIMILARITY_PLACES = 9

# A rating this close to its user's mean is the mean: a user whose ratings are
# all equal then has deviation 0 however the mean was summed.
MEAN_TOLERANCE = 1e-9

# Fixed value: the neighbourhood sizes the reference results are reported for.
SWEEP_KS = (10, 30, 50, 100, 200, 300, 400, 800, 943)


@dataclass(frozen=True)
class RatingScale:
    """Inclusive bounds of the rating scale."""

    lo: float = 1.0
    hi: float = 5.0


@dataclass(frozen=True)
class FitSettings:
    """Sizes that decide how similarity work is divided; none changes a result.

    An item with more than ``hot_item_ratings`` ratings is hot: joining its
    raters with each other would grow with the square of its popularity; unless it has no more
    raters than there would be blocks of users, each of which its ratings would be sent to.  None lets
    ``fit`` choose the number from the ratings (operators.vectors.split_at).  Users
    who rated a hot item are compared tile by tile (``tile_users`` against
    ``tile_users``) instead, unless they have more than ``tiled_user_ratings``
    ratings themselves, which would make the tile too tall.  ``skip_tiles`` looks for
    the k nearest only in tiles whose bounds allow one (operators.bounded): always, never, or (None) where the
    typical user has little weight on hot items.
    """

    hot_item_ratings: int | None = 1_000
    tiled_user_ratings: int = 100_000
    tile_users: int = 2_048
    tile_ratings: int = 500_000
    skip_tiles: bool | None = None

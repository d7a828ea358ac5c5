"""Venue segmentation (k-means over rating, review count and visit count)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import enrich_with_defaults
from ..operators.reshape import group_means
from ..operators.segments import assign_nearest, centroid_frame, feature_stats, fit_segments, standardize
from ..session import materialize

FEATURES = ("stars", "review_count", "total_checkins")


def segment_features(
    venues: DataFrame, visits: DataFrame | None, visits_by_part: DataFrame | None = None
) -> DataFrame:
    """Venues with a rating and a review count, plus their visit count (0 when none)."""
    if visits_by_part is not None:
        counts = visits_by_part.groupBy("business_id").agg(F.sum("visits").alias("total_checkins"))
    else:
        counts = visits.groupBy("business_id").agg(F.count(F.lit(1)).alias("total_checkins"))
    v = venues.select("business_id", "name", "stars", "review_count").filter(
        F.col("review_count").isNotNull() & F.col("stars").isNotNull()
    )
    return enrich_with_defaults(v, counts, ["business_id"], {"total_checkins": 0})


def segment_entities(
    features: DataFrame,
    k: int = 4,
    seeds: Sequence[int] = tuple(range(42, 52)),
) -> tuple[DataFrame, DataFrame]:
    """(venues with ``segment``, centroids in standardised units).

    The feature rows (one per venue) feed the statistics, every k-means start and the final
    assignment, so they are written once instead of being recomputed from the facts.
    """
    features = materialize(features)
    stats = feature_stats(features, FEATURES)
    z = standardize(features, FEATURES, stats=stats)
    zcols = [f + "_z" for f in FEATURES]
    centres = fit_segments(z, zcols, "business_id", k=k, seeds=seeds)
    assigned = assign_nearest(z, centres, zcols).drop(*zcols)
    return assigned, centroid_frame(features.sparkSession, centres, zcols)


def segment_profile(assigned: DataFrame) -> DataFrame:
    """Mean of each raw feature per segment."""
    return group_means(assigned, ["segment"], FEATURES)

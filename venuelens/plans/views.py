"""The five named views the questions read, from curated files or from remote stores, and all
ten questions answered over them with their default parameters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curation import expand_visits
from ..sources.docstore import docstore_options
from ..sources.jdbc import JdbcSpec, read_jdbc, read_options
from ..sources.switch import SourceSpec, load_views
from . import segmentation as seg
from . import venue_queries as vq
from ..session import materialize
from .curate import BUCKETED, curated_specs, parse_dates

VIEW_NAMES = ("business", "reviews", "tips", "users", "checkins")


def as_double(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double")) if column in df.columns else df


def remote_specs(
    docstore_uris: Mapping[str, str],
    reviews: JdbcSpec,
    users: JdbcSpec,
    database: str = "venues",
) -> dict[str, SourceSpec]:
    """Venues, tips and visits from document-store collections; reviews and users over JDBC.

    ``docstore_uris`` maps ``business``, ``tips`` and ``checkins`` to connection URIs (they may
    be different clusters). JDBC reads are split by key range when the spec names a column, by its
    predicates when it has any.
    """

    def doc(name: str, normalize=None) -> SourceSpec:
        return SourceSpec("mongodb", options=docstore_options(docstore_uris[name], database, name), normalize=normalize)

    def rel(spec: JdbcSpec, normalize=None) -> SourceSpec:
        # the load's own reader: key ranges (bounds asked for when not given) or predicates of a text key
        return SourceSpec("jdbc", options=read_options(spec), normalize=normalize, read=lambda spark: read_jdbc(spark, spec))

    return {
        "business": doc("business"),
        "tips": doc("tips"),
        "checkins": doc("checkins", expand_visits),
        # single-precision ratings in the relational tables are widened to double on read
        "reviews": rel(reviews, lambda df: parse_dates(as_double(df, "stars"))),
        "users": rel(users, lambda df: as_double(df, "average_stars")),
    }


def file_views(spark: SparkSession, curated_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The five views over curated layers written by ``run_curation``."""
    return load_views(spark, curated_specs(curated_dir, fmt))


def table_views(spark: SparkSession, curated_dir: str, table_prefix: str = "curated", fmt: str = "parquet") -> dict[str, DataFrame]:
    """The five views of a ``run_curation(..., buckets=n)`` run, the venues read through the catalog so
    that the planner knows their bucketing, plus its ``review_cube`` and ``visit_cube`` tables, which
    :func:`answer_all` takes in place of aggregating the facts again."""
    return {
        **file_views(spark, curated_dir, fmt),
        **{n: spark.table(f"{table_prefix}_{n}") for n in BUCKETED},
    }


def answer_all(
    views: Mapping[str, DataFrame], segments: bool = True, shared_aggregates: bool = True
) -> dict[str, DataFrame]:
    """Every question over the named views, with the original thresholds and sizes.

    With ``shared_aggregates`` the review facts are aggregated once per (venue, month) and the
    visits once per (venue, day part); both are written once and every question that needs
    per-venue or per-period measures rolls them up from there; views that hold the two written
    aggregates (:func:`table_views`) are read as they are. A full report then scans each fact
    table once (plus the (user, venue) pass of the reviewer question) instead of once per question.
    """
    b, r, u, c = views["business"], views["reviews"], views["users"], views["checkins"]
    rc = vc = None
    if shared_aggregates:
        rc = views["review_cube"] if "review_cube" in views else materialize(vq.review_cube(r))
        vc = views["visit_cube"] if "visit_cube" in views else materialize(vq.visit_cube(c))
    tiers = vq.price_tier_rating(b)
    yoy = vq.yoy_change(r, b, cube=rc)
    gaps = vq.rolling_gap(r, b, cube=rc)
    leaders = vq.daypart_leaders(c, b, visits_by_part=vc)
    opportunity = vq.market_opportunity(b)
    leaders_by_category = vq.category_leaders(r, b, cube=rc)
    out = {
        "market_opportunity": opportunity,
        "bubble_scale": vq.market_bubbles(opportunity),
        "daypart_leaders": leaders,
        "daypart_profile": vq.daypart_profile(leaders),
        "category_rating": vq.category_rating(r, b, cube=rc),
        "price_tier_rating": tiers,
        "price_tier_matrix": vq.price_tier_matrix(tiers),
        "category_leaders": leaders_by_category,
        "leaders_profile": vq.leaders_profile(leaders_by_category),
        "reviewer_influence": vq.reviewer_influence(r, u),
        "yoy_change": yoy,
        "yoy_top_groups": vq.yoy_top_groups(yoy),
        "traffic_vs_rating": vq.traffic_vs_rating(c, r, b, cube=rc, visits_by_part=vc),
        "rolling_gap": gaps,
        "gap_labels": vq.gap_labels(gaps),
    }
    if segments:
        assigned, centroids = seg.segment_entities(seg.segment_features(b, c, visits_by_part=vc))
        out.update(
            entity_segments=assigned, segment_centroids=centroids, segment_profile=seg.segment_profile(assigned)
        )
    return out

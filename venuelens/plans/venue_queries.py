"""The venue questions as DataFrame plans.

Canonical inputs (bindings rename their own columns to these):

* ``venues``  - business_id (unique), name, city, state, stars, review_count, is_open,
  categories (delimited text), a price-tier column (text)
* ``reviews`` - review_id, user_id, business_id, stars, useful, date (timestamp or text)
* ``users``   - user_id, name, average_stars
* ``visits``  - business_id, checkin_ts (long form, one row per visit)

Thresholds and sizes are parameters; defaults are the values the original questions used.
Fact tables are always aggregated to one row per (venue, key) *before* they meet the venue
dimension, so the large side of every join is a pre-aggregate and skewed venues are reduced by
map-side partial aggregation. Every limit carries a total order (a key tie-break).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp, month_label, month_start
from ..functions.dayparts import day_part
from ..functions.lists import split_trim
from ..functions.stats import centred_second_moment, mean_from_moments, merge_moments, moments, pop_stddev_from_moments
from ..operators.ranking import measure_ranks, rows_of_top_groups, top_per_group
from ..operators.reshape import bubble_scale, group_means, pivot_matrix
from ..session import materialize

# The four cities of the day-part question.
DAYPART_CITIES = ("Philadelphia", "Tampa", "Tucson", "Nashville")


def explode_categories(
    venues: DataFrame, sep: str = ",", column: str = "categories", keep: Sequence[str] = ("business_id",)
) -> DataFrame:
    """One row per (venue, trimmed category). NULL list: no row; empty text: one empty category."""
    return venues.select(*keep, F.explode(split_trim(column, sep)).alias("category"))


def review_cube(reviews: DataFrame) -> DataFrame:
    """Reviews aggregated once per (venue, month): every per-venue and per-period measure of the
    questions (counts, rated counts, sums and centred second moments of the rating, review-id counts)
    can be rolled up from it, so a full report scans the review facts once."""
    month = month_start(as_timestamp(reviews, "date"))
    return reviews.groupBy("business_id", month.alias("review_month")).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count("stars").alias("rated"),
        F.sum("stars").alias("stars_sum"),
        centred_second_moment("stars").alias("stars_m2"),
        F.count("review_id").alias("review_ids"),
    )


def visit_cube(visits: DataFrame) -> DataFrame:
    """Visits aggregated once per (venue, day part); per-venue visit counts roll up from it."""
    return visits.groupBy("business_id", day_part("checkin_ts").alias("day_segment")).agg(
        F.count(F.lit(1)).alias("visits")
    )


# --------------------------------------------------------------------------------------------
# Q1 market opportunity
# --------------------------------------------------------------------------------------------
def market_opportunity(
    venues: DataFrame,
    group: Sequence[str] = ("city", "state"),
    min_venues: int = 30,
    top_k: int = 20,
) -> DataFrame:
    """Per group: venue count, mean rating, % open, review volume and
    ``mean rating x open share x ln(volume + 1)``; groups with >= ``min_venues``; top ``k``."""
    g = list(group)
    agg = venues.groupBy(*g).agg(
        F.count(F.lit(1)).alias("total_venues"),
        F.avg("stars").alias("__avg"),
        F.sum("is_open").alias("__open"),
        F.sum("review_count").alias("total_reviews"),
    ).filter(F.col("total_venues") >= min_venues)
    share = F.col("__open") / F.col("total_venues")
    out = agg.select(
        *g,
        "total_venues",
        F.round("__avg", 2).alias("avg_stars"),
        F.round(share * 100, 1).alias("pct_open"),
        F.col("total_reviews").cast("bigint").alias("total_reviews"),
        F.round(F.col("__avg") * share * F.ln(F.col("total_reviews") + 1), 3).alias("market_score"),
    )
    return out.orderBy(F.col("market_score").desc_nulls_last(), *[F.col(c).asc() for c in g]).limit(top_k)


def market_bubbles(opportunity: DataFrame) -> DataFrame:
    """Bubble size for the opportunity chart: volume / max volume x 800 + 50 (bounded input)."""
    return bubble_scale(opportunity, "total_reviews")


# --------------------------------------------------------------------------------------------
# Q2 day-part leaders
# --------------------------------------------------------------------------------------------
def daypart_leaders(
    visits: DataFrame,
    venues: DataFrame,
    cities: Sequence[str] | None = DAYPART_CITIES,
    top_k: int = 3,
    by: str = "name",
    visits_by_part: DataFrame | None = None,
) -> DataFrame:
    """Top venues per (city, day part) by visit count, rank with gaps ``<= k``.

    ``by="name"`` groups by (city, name, part) as the original question does: branches of a chain
    in one city merge. ``by="business_id"`` keeps venues apart.
    """
    cube = visits_by_part if visits_by_part is not None else visit_cube(visits)
    per_venue = cube.select("business_id", "day_segment", F.col("visits").alias("__n"))
    v = venues
    if cities is not None:
        v = v.filter(F.col("city").isin(list(cities)))
    key = ["name"] if by == "name" else ["business_id", "name"]
    joined = per_venue.join(v.select("business_id", "city", "name"), "business_id")
    traffic = joined.groupBy("city", *([] if by == "name" else ["business_id"]), "name", "day_segment").agg(
        F.sum("__n").alias("checkin_count")
    )
    ranked = top_per_group(
        traffic, ["city", "day_segment"], [F.col("checkin_count").desc()], top_k, "rank", "traffic_rank"
    )
    cols = ["city", "day_segment", *key, "checkin_count"]
    return ranked.select(*cols).orderBy("city", F.col("checkin_count").desc(), "day_segment", *key)


def daypart_profile(leaders: DataFrame) -> DataFrame:
    """Mean visit count per (city, day part) over the leader rows (the chart's bar height)."""
    return group_means(leaders, ["city", "day_segment"], ["checkin_count"]).withColumnRenamed(
        "checkin_count_mean", "mean_checkins"
    )


# --------------------------------------------------------------------------------------------
# Q3 category rating
# --------------------------------------------------------------------------------------------
def category_rating(
    reviews: DataFrame,
    venues: DataFrame,
    sep: str = ", ",
    min_reviews: int = 1000,
    top_k: int = 15,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Mean and population deviation of review ratings per category; >= ``min_reviews`` reviews.

    Reviews are reduced to moments per venue first, then joined to the exploded categories and
    combined, so the largest table is never multiplied by the categories per venue.
    """
    if cube is not None:
        months = cube.select(
            "business_id", F.col("reviews").alias("_rows"), F.col("rated").alias("_n"),
            F.col("stars_sum").alias("_s"), F.col("stars_m2").alias("_m2"),
        )
        per_venue = merge_moments(months, ["business_id"], few_parts=True)  # a row a month
    else:
        per_venue = reviews.groupBy("business_id").agg(*moments("stars"))
    cats = explode_categories(venues.filter(F.col("categories").isNotNull()), sep)
    per_cat = merge_moments(cats.join(per_venue, "business_id"), ["category"], having=F.col("_rows") >= min_reviews)
    out = per_cat.select(
        "category",
        F.col("_rows").alias("total_reviews"),
        F.round(mean_from_moments(), 2).alias("avg_stars"),
        F.round(pop_stddev_from_moments(), 2).alias("stddev_stars"),
    )
    return out.orderBy(
        F.col("avg_stars").desc_nulls_last(), F.col("total_reviews").desc(), F.col("category").asc()
    ).limit(top_k)


# --------------------------------------------------------------------------------------------
# Q4 rating by category and price tier
# --------------------------------------------------------------------------------------------
def price_tier_rating(
    venues: DataFrame,
    tier: str = "attributes.RestaurantsPriceRange2",
    sep: str = ",",
    min_venues: int = 30,
) -> DataFrame:
    """Mean venue rating per (category, price tier) over open venues that have a tier."""
    v = venues.filter(F.col(tier).isNotNull() & (F.col("is_open") == 1))
    cats = v.select(
        F.explode(split_trim("categories", sep)).alias("category"),
        F.col(tier).alias("price_tier"),
        "stars",
    )
    agg = cats.groupBy("category", "price_tier").agg(
        F.round(F.avg("stars"), 2).alias("avg_rating"), F.count(F.lit(1)).alias("total_venues")
    )
    return agg.filter(F.col("total_venues") >= min_venues).orderBy(
        F.col("total_venues").desc(), "category", "price_tier"
    )


def price_tier_matrix(
    tier_rating: DataFrame, tiers: Sequence[int] = (1, 2, 3, 4), top_rows: int = 20
) -> DataFrame:
    """Category x tier matrix of mean rating over the ``top_rows`` categories by venue count."""
    return pivot_matrix(
        tier_rating, "category", "price_tier", "avg_rating", tiers, "total_venues", top_rows
    )


# --------------------------------------------------------------------------------------------
# Q5 category leaders
# --------------------------------------------------------------------------------------------
def category_leaders(
    reviews: DataFrame,
    venues: DataFrame,
    sep: str = ",",
    min_reviews: int = 20,
    top_k: int = 3,
    by: str = "name",
    cube: DataFrame | None = None,
) -> DataFrame:
    """Top venues per category by review count then mean rating (dense rank ``<= k``).

    The rank orders on the unrounded mean; the output mean is rounded to 2.
    """
    if cube is not None:
        per_venue = cube.groupBy("business_id").agg(
            F.sum("review_ids").alias("__cnt"), F.sum("stars_sum").alias("__s"), F.sum("rated").alias("__ns")
        )
    else:
        per_venue = reviews.groupBy("business_id").agg(
            F.count("review_id").alias("__cnt"), F.sum("stars").alias("__s"), F.count("stars").alias("__ns")
        )
    keep = ["business_id", "name"]
    cats = explode_categories(venues.filter(F.col("categories").isNotNull()), sep, keep=keep)
    key = ["name"] if by == "name" else ["business_id", "name"]
    stats = (
        cats.join(per_venue, "business_id")
        .groupBy(F.col("category").alias("category_name"), *key)
        .agg(
            F.sum("__cnt").alias("total_reviews"),
            F.try_divide(F.sum("__s"), F.sum("__ns")).alias("__avg"),
        )
        .filter(F.col("total_reviews") >= min_reviews)
    )
    ranked = top_per_group(
        stats,
        ["category_name"],
        [F.col("total_reviews").desc(), F.col("__avg").desc_nulls_last()],
        top_k,
        "dense_rank",
        "market_rank",
    )
    return ranked.select(
        "category_name",
        "market_rank",
        *key,
        "total_reviews",
        F.round("__avg", 2).alias("avg_rating"),
    ).orderBy("category_name", "market_rank", *key)


def leaders_profile(leaders: DataFrame, head: int = 30) -> DataFrame:
    """Mean review count per (category, name) over the first ``head`` leader rows in report
    order (category, rank, then name and count as tie-breaks) - the leaders chart's bars."""
    first = leaders.orderBy(
        "category_name", "market_rank", F.col("total_reviews").desc(), "name"
    ).limit(head)
    return first.groupBy("category_name", "name").agg(F.avg("total_reviews").alias("mean_reviews"))


# --------------------------------------------------------------------------------------------
# Q6 reviewer influence
# --------------------------------------------------------------------------------------------
def reviewer_influence(
    reviews: DataFrame,
    users: DataFrame,
    min_reviews: int = 50,
    top_k: int = 20,
    weights: tuple[str, str, str] = ("0.4", "0.3", "0.3"),
) -> DataFrame:
    """Reviews written, distinct venues, useful votes -> weighted influence score; top ``k``.

    Two-stage aggregation (user, venue) then user, the plan Spark makes of ``COUNT(DISTINCT)``, with
    the other sums taken along.
    Weights are exact decimals, as in SQL text.
    """
    per_pair = reviews.groupBy("user_id", "business_id").agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum("useful").alias("__u"),
        F.sum("stars").alias("__s"),
        F.count("stars").alias("__ns"),
    )
    per_user = per_pair.groupBy("user_id").agg(
        F.sum("__n").alias("__total"),
        F.count("business_id").alias("__distinct"),
        F.sum("__u").alias("__useful"),
        F.round(F.try_divide(F.sum("__s"), F.sum("__ns")), 2).alias("__avg"),
    )
    enriched = users.select("user_id", "name", "average_stars").join(per_user, "user_id", "left")
    total = F.coalesce("__total", F.lit(0))
    distinct = F.coalesce("__distinct", F.lit(0))
    useful = F.coalesce("__useful", F.lit(0))
    w1, w2, w3 = (F.lit(Decimal(w)) for w in weights)
    score = F.round(total * w1 + distinct * w2 + useful * w3, 2).cast("double")
    out = enriched.filter(total >= min_reviews).select(
        "user_id",
        "name",
        total.cast("bigint").alias("total_reviews"),
        distinct.cast("bigint").alias("distinct_venues"),
        useful.cast("bigint").alias("total_useful"),
        F.coalesce("__avg", "average_stars").alias("avg_stars_given"),
        score.alias("influence_score"),
    )
    return out.orderBy(F.col("influence_score").desc(), F.col("user_id").asc()).limit(top_k)


# --------------------------------------------------------------------------------------------
# Q7 year-over-year change
# --------------------------------------------------------------------------------------------
def yoy_change(
    reviews: DataFrame | None,
    venues: DataFrame,
    group: str = "state",
    calendar: bool = False,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Reviews per (group, year) and % change on the previous *present* year (NULL first).

    ``calendar=True`` compares with year - 1 only (a RANGE frame): NULL when that year is absent.
    """
    if cube is not None:
        per_venue = cube.groupBy("business_id", F.year("review_month").alias("yr")).agg(
            F.sum("reviews").alias("__n")
        )
    else:
        yr = F.year(as_timestamp(reviews, "date"))
        per_venue = reviews.groupBy("business_id", yr.alias("yr")).agg(F.count(F.lit(1)).alias("__n"))
    yearly = (
        per_venue.join(venues.select("business_id", group), "business_id")
        .groupBy(group, "yr")
        .agg(F.sum("__n").cast("bigint").alias("reviews"))
    )
    w = Window.partitionBy(group).orderBy("yr")
    prev = F.max("reviews").over(w.rangeBetween(-1, -1)) if calendar else F.lag("reviews").over(w)
    return yearly.withColumn(
        "yoy_pct_change", F.round(F.try_divide(F.col("reviews") - prev, prev) * 100, 1)
    ).select(group, "yr", "reviews", "yoy_pct_change").orderBy(group, "yr")


def yoy_top_groups(yoy: DataFrame, k: int = 5, group: str = "state") -> DataFrame:
    """Rows of the ``k`` groups with the most reviews overall (the chart's lines).

    The yearly frame (groups x years) is written once first: both the ranking of groups and the
    returned rows read it, so the review facts behind it are scanned once.
    """
    return rows_of_top_groups(materialize(yoy), group, "reviews", k)


# --------------------------------------------------------------------------------------------
# Q8 traffic against satisfaction
# --------------------------------------------------------------------------------------------
def traffic_vs_rating(
    visits: DataFrame,
    reviews: DataFrame,
    venues: DataFrame,
    group: str = "state",
    min_reviews: int = 30,
    traffic_at_least: float = 0.90,
    rating_at_most: float = 0.25,
    top_k: int = 30,
    cube: DataFrame | None = None,
    visits_by_part: DataFrame | None = None,
) -> DataFrame:
    """Busy but poorly rated venues: within each group, traffic percent rank >= 0.90 and
    rating percent rank <= 0.25 among venues with visits and >= ``min_reviews`` reviews.

    The venue frame is written once. A percent rank grows with its value, so each threshold is one
    cut-off value per group: the ranks of the distinct values (:func:`measure_ranks`) give the
    cut-offs, the frame is filtered by them, and ranks are looked up for the ``top_k`` rows alone.
    """
    if visits_by_part is not None:
        checkins = visits_by_part.groupBy("business_id").agg(F.sum("visits").alias("__checkins"))
    else:
        checkins = visits.groupBy("business_id").agg(F.count(F.lit(1)).alias("__checkins"))
    if cube is not None:
        revs = cube.groupBy("business_id").agg(
            F.sum("reviews").alias("__reviews"),
            F.round(F.try_divide(F.sum("stars_sum"), F.sum("rated")), 2).alias("__avg"),
        )
    else:
        revs = reviews.groupBy("business_id").agg(
            F.count(F.lit(1)).alias("__reviews"), F.round(F.avg("stars"), 2).alias("__avg")
        )
    combined = (
        venues.select("business_id", "name", "city", group, "stars")
        .join(checkins, "business_id", "left")
        .join(revs, "business_id", "left")
        .select(
            "business_id",
            "name",
            "city",
            group,
            F.coalesce("__checkins", F.lit(0)).alias("total_checkins"),
            F.coalesce("__reviews", F.lit(0)).alias("total_reviews"),
            F.coalesce("__avg", "stars").alias("avg_review_stars"),
        )
        .filter((F.col("total_checkins") > 0) & (F.col("total_reviews") >= min_reviews))
    )
    # one row per venue feeds the rows and both ranks, so the facts behind it are scanned once
    combined = materialize(combined)
    ranks = measure_ranks(combined, [group], ["total_checkins", "avg_review_stars"])
    traffic = ranks.filter("measure = 0").select(F.col(group).alias("__g1"), F.col("value").alias("__v1"), F.round("pct_rank", 4).alias("traffic_pct_rank"))
    rating = ranks.filter("measure = 1").select(F.col(group).alias("__g2"), F.col("value").alias("__v2"), F.round("pct_rank", 4).alias("rating_pct_rank"))
    cuts = ranks.groupBy(F.col(group).alias("__g")).agg(
        F.min(F.when((F.col("measure") == 0) & (F.round("pct_rank", 4) >= traffic_at_least), F.col("value"))).alias("__low"),
        F.max(F.when((F.col("measure") == 1) & (F.round("pct_rank", 4) <= rating_at_most), F.col("value"))).alias("__high"),
    )
    order = [F.col("total_checkins").desc(), F.col("avg_review_stars").asc(), F.col("business_id").asc()]
    poor = F.col("avg_review_stars").isNull() | (F.col("avg_review_stars") <= F.col("__high"))
    same = F.col(group).eqNullSafe(F.col("__g")) & (F.col("total_checkins") >= F.col("__low")) & poor
    chosen = combined.join(cuts, same).select(*combined.columns).orderBy(*order).limit(top_k)
    top = F.broadcast(chosen)  # at most top_k rows
    found = traffic.join(top, F.col("__g1").eqNullSafe(F.col(group)) & (F.col("__v1") == F.col("total_checkins")))
    found = rating.join(F.broadcast(found), F.col("__g2").eqNullSafe(F.col(group)) & F.col("__v2").eqNullSafe(F.col("avg_review_stars")))
    return found.select(*combined.columns, "traffic_pct_rank", "rating_pct_rank").orderBy(*order)


# --------------------------------------------------------------------------------------------
# Q9 rolling quality gap
# --------------------------------------------------------------------------------------------
def rolling_gap(
    reviews: DataFrame,
    venues: DataFrame,
    window_months: int = 3,
    min_reviews: int = 5,
    top_k: int = 15,
    calendar: bool = False,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Monthly mean rating against its own moving mean over the last ``window_months``
    *observed* months; months with fewer than ``min_reviews`` reviews feed the moving mean but
    are not reported; the ``k`` lowest (rounded) gaps.

    ``calendar=True`` averages over the last ``window_months`` calendar months instead (a RANGE
    frame on a month number), so a gap in the history shortens the window.
    """
    if cube is not None:
        monthly = cube.select(
            "business_id", "review_month", F.col("review_ids").alias("__cnt"),
            F.col("stars_sum").alias("__s"), F.col("rated").alias("__ns"),
        )
    else:
        month = month_start(as_timestamp(reviews, "date"))
        monthly = reviews.groupBy("business_id", month.alias("review_month")).agg(
            F.count("review_id").alias("__cnt"), F.sum("stars").alias("__s"), F.count("stars").alias("__ns")
        )
    monthly = monthly.join(venues.select("business_id", "name"), "business_id").withColumn(
        "__avg", F.try_divide(F.col("__s"), F.col("__ns"))
    )
    if calendar:
        month_no = F.year("review_month") * 12 + F.month("review_month")
        w = Window.partitionBy("business_id").orderBy(month_no).rangeBetween(-(window_months - 1), 0)
    else:
        w = Window.partitionBy("business_id").orderBy("review_month").rowsBetween(-(window_months - 1), 0)
    rolled = monthly.withColumn("__roll", F.avg("__avg").over(w))
    out = rolled.filter(F.col("__cnt") >= min_reviews).select(
        "business_id",
        "name",
        "review_month",
        F.round("__avg", 2).alias("current_month_rating"),
        F.round("__roll", 2).alias("rolling_avg_rating"),
        F.round(F.col("__avg") - F.col("__roll"), 2).alias("performance_gap"),
    )
    return out.orderBy(
        F.col("performance_gap").asc_nulls_first(), F.col("business_id").asc(), F.col("review_month").asc()
    ).limit(top_k)


def gap_labels(gaps: DataFrame) -> DataFrame:
    """``name (yyyy-MM)`` label per reported gap (the chart's bar label)."""
    return gaps.withColumn(
        "label", F.concat(F.col("name"), F.lit(" ("), month_label(F.col("review_month")), F.lit(")"))
    )

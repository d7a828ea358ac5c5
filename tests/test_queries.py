"""Each venue question against its rule, worked out by brute force over the collected rows."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from venuelens.plans import venue_queries as vq

from .venue_fixture import analytics_frames


@pytest.fixture(scope="module")
def views(spark):
    frames = analytics_frames(spark)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def same(a, b):
    ra = sorted((tuple(r) for r in a.collect()), key=repr)
    rb = sorted((tuple(r) for r in b.collect()), key=repr)
    assert ra == rb
    return len(ra)


def test_market_opportunity(spark, views):
    got = vq.market_opportunity(views["business"], min_venues=3, top_k=20)
    want = spark.sql("""
        SELECT city, state, COUNT(*) AS total_venues, ROUND(AVG(stars), 2) AS avg_stars,
               ROUND(SUM(is_open) / COUNT(*) * 100, 1) AS pct_open, SUM(review_count) AS total_reviews,
               ROUND(AVG(stars) * (SUM(is_open) / COUNT(*)) * LN(SUM(review_count) + 1), 3) AS market_score
        FROM business GROUP BY city, state HAVING COUNT(*) >= 3
        ORDER BY market_score DESC, city, state LIMIT 20""")
    assert same(got, want) > 0


def half_up(x, n):
    return None if x is None else float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP))


def mean(values):
    return sum(values) / len(values)


def rows(views, name):
    return views[name].collect()


def by_venue(views):
    out = defaultdict(list)
    for r in rows(views, "reviews"):
        out[r.business_id].append(r)
    return out


def labels(venue, sep):
    return [] if venue.categories is None else [c.strip() for c in venue.categories.split(sep)]


def test_daypart_leaders(spark, views):
    names = ("Night/Early Morning (0-6)", "Morning (6-12)", "Afternoon (12-18)", "Evening (18-24)")
    venues = {v.business_id: v for v in rows(views, "business")}
    visits = defaultdict(int)
    for c in rows(views, "checkins"):
        if c.business_id in venues:
            v = venues[c.business_id]
            visits[v.city, names[0 if c.checkin_ts is None else c.checkin_ts.hour // 6], v.name] += 1
    want = [
        (city, part, name, n)
        for (city, part, name), n in visits.items()
        if city in ("Philadelphia", "Tampa", "Tucson", "Nashville")
        and sum(m > n for (c, p, _), m in visits.items() if (c, p) == (city, part)) < 3
    ]
    got = [tuple(r) for r in vq.daypart_leaders(views["checkins"], views["business"]).collect()]
    assert got == sorted(want, key=lambda r: (r[0], -r[3], r[1], r[2])) and got


def test_category_rating(spark, views):
    reviews, stars = by_venue(views), defaultdict(list)
    for v in rows(views, "business"):
        for c in labels(v, ", "):
            stars[c] += [r.stars for r in reviews[v.business_id]]
    want = []
    for c, x in stars.items():
        if len(x) >= 50:
            spread = (sum((y - mean(x)) ** 2 for y in x) / len(x)) ** 0.5
            want.append((c, len(x), half_up(mean(x), 2), half_up(round(spread, 9), 2)))
    want.sort(key=lambda r: (-r[2], -r[1], r[0]))
    got = vq.category_rating(views["reviews"], views["business"], sep=", ", min_reviews=50, top_k=15)
    assert [tuple(r) for r in got.collect()] == want[:15] and want


def test_price_tier_rating(spark, views):
    got = vq.price_tier_rating(views["business"], min_venues=2)
    want = spark.sql("""
        SELECT TRIM(x) AS category, attributes.RestaurantsPriceRange2 AS price_tier,
               ROUND(AVG(stars), 2) AS avg_rating, COUNT(*) AS total_venues
        FROM business LATERAL VIEW explode(split(categories, ',')) e AS x
        WHERE attributes.RestaurantsPriceRange2 IS NOT NULL AND is_open = 1
        GROUP BY TRIM(x), attributes.RestaurantsPriceRange2 HAVING COUNT(*) >= 2""")
    n = same(got, want)
    assert n > 0
    matrix = vq.price_tier_matrix(got).collect()
    assert all(set(r.asDict()) == {"category", "tier_1", "tier_2", "tier_3", "tier_4"} for r in matrix)


def test_category_leaders(spark, views):
    reviews, stars = by_venue(views), defaultdict(list)
    for v in rows(views, "business"):
        for c in labels(v, ","):
            stars[c, v.name] += [r.stars for r in reviews[v.business_id]]
    result = {k: (len(x), mean(x)) for k, x in stars.items() if len(x) >= 20}
    want = []
    for (c, name), own in result.items():
        rank = 1 + len({other for (c2, _), other in result.items() if c2 == c and other > own})
        if rank <= 3:
            want.append((c, rank, name, own[0], half_up(own[1], 2)))
    got = [tuple(r) for r in vq.category_leaders(views["reviews"], views["business"], min_reviews=20).collect()]
    assert got == sorted(want, key=lambda r: r[:3]) and got


def test_reviewer_influence(spark, views):
    written = defaultdict(list)
    for r in rows(views, "reviews"):
        written[r.user_id].append(r)
    want = []
    for u in rows(views, "users"):
        own = written[u.user_id]
        if len(own) >= 50:
            venues, useful = len({r.business_id for r in own}), sum(r.useful for r in own)
            score = Decimal(4 * len(own) + 3 * venues + 3 * useful) / 10
            want.append((u.user_id, u.name, len(own), venues, useful, half_up(mean([r.stars for r in own]), 2), float(score)))
    want.sort(key=lambda r: (-r[6], r[0]))
    got = vq.reviewer_influence(views["reviews"], views["users"], min_reviews=50, top_k=20)
    assert [tuple(r) for r in got.collect()] == want[:20] and want


def test_yoy_change(spark, views):
    state = {v.business_id: v.state for v in rows(views, "business")}
    counts = defaultdict(int)
    for r in rows(views, "reviews"):
        if r.business_id in state:
            counts[state[r.business_id], int(r.date[:4]) if r.date and r.date[:4].isdigit() else None] += 1
    got_frame = vq.yoy_change(views["reviews"], views["business"])
    got = [tuple(r) for r in got_frame.collect()]
    place = lambda y: (y is not None, y or 0)  # noqa: E731 a missing year comes first
    want = []
    for (s, y), n in counts.items():
        earlier = [m for t, m in counts if t == s and place(m) < place(y)]
        before = counts[s, max(earlier, key=place)] if earlier else None
        want.append((s, y, n, None if before is None else half_up((n - before) / before * 100, 1)))
    assert got == sorted(want, key=lambda r: (r[0], place(r[1]))) and got
    top = vq.yoy_top_groups(got_frame, k=2)
    assert top.select("state").distinct().count() == 2


def test_traffic_vs_rating(spark, views):
    visits, reviews = defaultdict(int), by_venue(views)
    for c in rows(views, "checkins"):
        visits[c.business_id] += 1
    live = []
    for v in rows(views, "business"):
        own = reviews[v.business_id]
        if visits[v.business_id] and len(own) >= 5:
            live.append((v.business_id, v.name, v.city, v.state, visits[v.business_id], len(own), half_up(mean([r.stars for r in own]), 2)))

    def rank(row, at):
        peers = [x for x in live if x[3] == row[3]]
        return half_up(sum(x[at] < row[at] for x in peers) / (len(peers) - 1), 4) if len(peers) > 1 else 0.0

    want = [(*x, rank(x, 4), rank(x, 6)) for x in live]
    want = sorted((x for x in want if x[7] >= 0.5 and x[8] <= 0.5), key=lambda x: (-x[4], x[6], x[0]))[:30]
    got = vq.traffic_vs_rating(
        views["checkins"], views["reviews"], views["business"], min_reviews=5, traffic_at_least=0.5, rating_at_most=0.5, top_k=30
    )
    assert [tuple(r) for r in got.collect()] == want and want


def test_rolling_gap(spark, views):
    names = {v.business_id: v.name for v in rows(views, "business")}
    months = defaultdict(list)
    for r in rows(views, "reviews"):
        if r.business_id in names:
            months[r.business_id, r.date[:7] if r.date else ""].append(r.stars)  # a missing month comes first
    want = []
    for (b, m), x in months.items():
        if len(x) >= 2:
            near = sorted(k for k in months if k[0] == b and k[1] <= m)[-3:]
            own, moved = mean(x), mean([mean(months[k]) for k in near])
            want.append((b, names[b], m, half_up(own, 2), half_up(moved, 2), half_up(own - moved, 2)))
    want.sort(key=lambda r: (r[5], r[0], r[2]))
    frame = vq.rolling_gap(views["reviews"], views["business"], min_reviews=2, top_k=15)
    got = [(r.business_id, r.name, str(r.review_month or "")[:7], *tuple(r)[3:]) for r in frame.collect()]
    assert got == want[:15]
    assert all(r.label.endswith(")") and " (" in r.label for r in vq.gap_labels(frame).collect() if r.review_month)


def test_rolling_window_edges(spark):
    """Months 1, 2, 5 with means 4, 2, 3 -> moving means 4, 3, 3 and gaps 0, -1, 0."""
    rows = [("b", "x", f"2020-0{m}-10 00:00:00", s, f"r{m}{i}") for m, s in ((1, 4.0), (2, 2.0), (5, 3.0)) for i in range(5)]
    reviews = spark.createDataFrame(rows, "business_id string, name string, date string, stars double, review_id string")
    venues = spark.createDataFrame([("b", "x")], "business_id string, name string")
    got = sorted((str(r.review_month)[:7], r.rolling_avg_rating, r.performance_gap) for r in vq.rolling_gap(reviews, venues).collect())
    assert got == [("2020-01", 4.0, 0.0), ("2020-02", 3.0, -1.0), ("2020-05", 3.0, 0.0)]


def test_yoy_edges(spark):
    """2018: 10 reviews, 2020: 15 (2019 absent) -> NULL, then 50.0 against the previous present year."""
    rows = [(f"r{y}{i}", "b", f"{y}-05-01") for y, n in ((2018, 10), (2020, 15)) for i in range(n)]
    reviews = spark.createDataFrame(rows, "review_id string, business_id string, date string")
    venues = spark.createDataFrame([("b", "S")], "business_id string, state string")
    got = sorted((r.yr, r.yoy_pct_change) for r in vq.yoy_change(reviews, venues).collect())
    assert got == [(2018, None), (2020, 50.0)]


def test_calendar_periods(spark):
    """Months 1, 2, 4 with means 4, 2, 3: observed rows give 3.0 at month 4, calendar months 2.5."""
    rows = [("b", "x", f"2020-0{m}-10 00:00:00", s, f"r{m}{i}") for m, s in ((1, 4.0), (2, 2.0), (4, 3.0)) for i in range(5)]
    reviews = spark.createDataFrame(rows, "business_id string, name string, date string, stars double, review_id string")
    venues = spark.createDataFrame([("b", "x", "S")], "business_id string, name string, state string")
    obs = {str(r.review_month)[:7]: r.rolling_avg_rating for r in vq.rolling_gap(reviews, venues).collect()}
    cal = {str(r.review_month)[:7]: r.rolling_avg_rating for r in vq.rolling_gap(reviews, venues, calendar=True).collect()}
    assert obs["2020-04"] == 3.0 and cal["2020-04"] == 2.5 and cal["2020-02"] == 3.0
    yrows = [(f"r{y}{i}", "b", f"{y}-05-01") for y, n in ((2018, 10), (2020, 15)) for i in range(n)]
    yrev = spark.createDataFrame(yrows, "review_id string, business_id string, date string")
    got = sorted((r.yr, r.yoy_pct_change) for r in vq.yoy_change(yrev, venues, calendar=True).collect())
    assert got == [(2018, None), (2020, None)]


def test_merge_by_id(spark, views):
    by_id = vq.daypart_leaders(views["checkins"], views["business"], by="business_id")
    assert "business_id" in by_id.columns and by_id.count() > 0
    leaders = vq.category_leaders(views["reviews"], views["business"], min_reviews=5, by="business_id")
    assert "business_id" in leaders.columns and leaders.count() > 0

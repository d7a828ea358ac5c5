"""A small deterministic venue-shaped dataset (entity layout of the original data)."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from venuelens.sources.schemas import BUSINESS_RAW, CHECKIN, REVIEW, TIP, USER_RAW

CITIES = [("Philadelphia", "PA"), ("Tampa", "FL"), ("Tucson", "AZ"), ("Nashville", "TN"), ("Reno", "NV")]
CATS = ["Food", "Bars", "Coffee & Tea", "Pizza", "Nightlife", "Shopping"]
NAMES = ["Alpha", "Beta", "Gamma", "Delta", "Omega", "Sigma", "Kappa"]


def rows(seed: int = 3):
    rnd = random.Random(seed)
    business = []
    for i in range(80):
        city, state = CITIES[i % len(CITIES)]
        k = rnd.randint(0, 3)
        cats = rnd.sample(CATS, k)
        if k == 0:
            categories = rnd.choice([None, ""])
        else:
            categories = rnd.choice([", ", ","]).join(cats)
        tier = rnd.choice(["1", "2", "3", "4", "None", None])
        attributes = None if rnd.random() < 0.1 else {"RestaurantsPriceRange2": tier}
        business.append(
            (f"b{i}", rnd.choice(NAMES), "addr", city, state, "00000", 1.0, 2.0,
             rnd.choice([1.0, 1.5, 2.0, 3.0, 3.5, 4.0, 4.5, 5.0]), rnd.randint(0, 400), rnd.choice([0, 1, 1]),
             attributes, categories, None)
        )
    users = [
        (f"u{j}", NAMES[j % len(NAMES)] + str(j), rnd.randint(0, 90), "2015-01-01", 1, 2, 3, None, "u1, u2", 4,
         rnd.choice([2.5, 3.0, 4.0]))
        for j in range(40)
    ]
    reviews = []
    for r in range(3000):
        y = rnd.choice([2017, 2018, 2019, 2020, 2021, 2022])
        date = f"{y}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d} 10:00:00"
        if r % 97 == 0:
            date = rnd.choice(["bad", None])
        reviews.append(
            (f"r{r}", f"u{int(rnd.random() ** 2 * 40)}", f"b{int(rnd.random() ** 1.5 * 80)}",
             float(rnd.randint(1, 5)), rnd.randint(0, 5), 0, 0, "text", date)
        )
    checkins = []
    for i in range(0, 80, 2):
        stamps = [
            f"{rnd.choice([2017, 2018, 2020, 2022])}-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)} "
            f"{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00"
            for _ in range(rnd.randint(1, 30))
        ]
        checkins.append((f"b{i}", ", ".join(stamps)))
    tips = [(f"u{rnd.randint(0, 45)}", f"b{rnd.randint(0, 79)}", "tip", f"{rnd.choice([2016, 2019])}-01-01", 0) for _ in range(200)]
    return business, users, reviews, checkins, tips


def raw_frames(spark: SparkSession):
    b, u, r, c, t = rows()
    return {
        "business": spark.createDataFrame(b, BUSINESS_RAW),
        "user": spark.createDataFrame(u, USER_RAW),
        "review": spark.createDataFrame(r, REVIEW),
        "checkin": spark.createDataFrame(c, CHECKIN),
        "tip": spark.createDataFrame(t, TIP),
    }


def analytics_frames(spark: SparkSession):
    """Views as the queries see them: visits in long form, review dates as text."""
    raw = raw_frames(spark)
    visits = raw["checkin"].select(
        "business_id", F.explode(F.split("date", ", ")).alias("s")
    ).select("business_id", F.col("s").try_cast("timestamp_ntz").alias("checkin_ts"))
    return {"business": raw["business"], "users": raw["user"], "reviews": raw["review"], "checkins": visits}

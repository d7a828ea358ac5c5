"""Chained curation of raw venue data: trim -> sample users -> referential filter ->
year window -> packed visit filter -> sample reviews, as one lazy plan per output, plus the
kept visits in typed long form.

Sampling is a key hash, so the user sample, the referential filter and the review sample are
row-local predicates that commute with each other and with the year window: nothing is
rewritten in place and no id set is held by the driver. ``run_curation`` writes each layer once
and parses each raw file once.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_timestamp
from ..functions.sampling import hash_keep
from ..operators.curation import (
    MONTH,
    YEAR,
    cascade_semi,
    expand_visits,
    packed_filter,
    sample_entities,
    sample_facts,
    trim_columns,
    year_window,
    with_periods,
)
from ..operators.reports import StepCounter, step_summary
from ..sources.files import read_json_lines, write_bucketed, write_layer
from ..sources.schemas import BUSINESS_DROP, CARRIED, ENTITY_SCHEMAS, USER_DROP, USER_DROP_PREFIX
from ..sources.snapshots import SnapshotStore, read_layer
from ..sources.switch import SourceSpec


@dataclass(frozen=True)
class CurationParams:
    # The original study window, sample fractions and seed.
    year_min: int = 2018
    year_max: int = 2021
    user_fraction: float = 0.40
    review_fraction: float = 0.20
    seed: int = 42
    review_salt: int | None = None  # defaults to ``seed``
    hash_method: str = "md5"  # or "xxhash64" (cheaper per row; not evaluable outside Spark)

    @property
    def fact_salt(self) -> int:
        return self.seed if self.review_salt is None else self.review_salt


def curate_facts(
    facts: DataFrame,
    entities: DataFrame | None,
    fact_key: str,
    entity_key: str,
    date_col: str | None,
    p: CurationParams,
    sample_key: str | None = None,
) -> DataFrame:
    """Facts of sampled entities, inside the year window, optionally sampled by fact id.

    ``entities`` are the already-sampled entities; the same hash predicate is applied to the
    fact key first, which removes most facts before the referential join.
    """
    out = facts
    if entities is not None:
        out = cascade_semi(
            out,
            entities,
            fact_key,
            entity_key,
            prefilter=hash_keep(fact_key, p.user_fraction, p.seed, p.hash_method),
        )
    if date_col is not None:
        out = year_window(out, date_col, p.year_min, p.year_max)
    if sample_key is not None:
        out = sample_facts(out, sample_key, p.review_fraction, p.fact_salt, p.hash_method)
    return out


def curate(raw: Mapping[str, DataFrame], p: CurationParams = CurationParams()) -> dict[str, DataFrame]:
    """Curated frames for the entities present in ``raw`` (user, business, review, tip, checkin),
    plus ``visit``: the kept visits in typed long form, parsed once here instead of in every query."""
    out: dict[str, DataFrame] = {}
    users = None
    if "user" in raw:
        users = sample_entities(
            trim_columns(raw["user"], USER_DROP, USER_DROP_PREFIX, CARRIED),  # no-op on a key-only frame
            "user_id",
            p.user_fraction,
            p.seed,
            p.hash_method,
        )
        out["user"] = users
    if "business" in raw:
        out["business"] = trim_columns(raw["business"], BUSINESS_DROP, carried=CARRIED)
    if "review" in raw:
        out["review"] = curate_facts(raw["review"], users, "user_id", "user_id", "date", p, "review_id")
    if "tip" in raw:
        out["tip"] = curate_facts(raw["tip"], users, "user_id", "user_id", "date", p)
    if "checkin" in raw:
        out["checkin"] = packed_filter(raw["checkin"], "date", p.year_min, p.year_max)
        # the same visits parsed once into typed long form (one row per visit)
        out["visit"] = expand_visits(out["checkin"])
    return out


CORRUPT = "_corrupt_record"

# Tables of a bucketed curation: one venue's rows in them are bounded by months and day parts, so no
# bucket is hot. Raw facts stay plain layers: a bucketed scan is one task a bucket, whatever it holds.
BUCKETED = ("business", "review_cube", "visit_cube")

# Layers with one date a row, and the tasks (hence files, at most) that write a month of them.
DATED = {"review": "date", "tip": "date", "visit": "checkin_ts"}
MONTH_TASKS = 16


def run_curation(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    out_dir: str,
    p: CurationParams = CurationParams(),
    fmt: str = "parquet",
    buckets: int | None = None,
    table_prefix: str = "curated",
    by_period: bool = False,
) -> DataFrame:
    """Read raw JSON lines, write each curated layer once, return the per-step row summary.

    All layers of a run become visible under ``out_dir`` together, by one commit after the last is
    written (:class:`~venuelens.sources.snapshots.SnapshotStore`); a run that ends before leaves the
    earlier layers as they were. ``read_layer`` reads a layer of the last commit.

    Only the columns the trimming names are lost: unlisted venue attributes stay in the
    ``attributes`` map, fields no schema declares in the map column ``other_fields``.

    With ``by_period``, the layers that have a date a row (reviews, tips, visits) are partitioned by its
    year and month, in folders that a year window or any filter on ``layer_year`` and ``layer_month``
    prunes; rows are laid out by month first, so a month's folder holds few files.

    With ``buckets``, the venues and the two fact aggregates (reviews per venue and month, visits per
    venue and day part) are also catalog tables ``<table_prefix>_business``, ``_review_cube`` and
    ``_visit_cube``, bucketed and sorted by ``business_id`` into as many files (under ``out_dir``):
    joins of those aggregates to the venues need no shuffle. The catalog's tables are replaced one by
    one, as they are written.
    """
    from .venue_queries import review_cube, visit_cube
    raw = {
        name: read_json_lines(spark, path, ENTITY_SCHEMAS[name], corrupt_column=CORRUPT, carry_column=CARRIED)
        for name, path in raw_paths.items()
    }
    outputs = list(curate(raw, p))
    store = SnapshotStore(spark, out_dir, fmt)
    run_dir = store.staged()
    clean = {k: v.drop(CORRUPT) for k, v in raw.items()}

    def step(name: str) -> StepCounter:
        counter = StepCounter(name)
        if name == "visit":
            # expanded from the written checkin layer, not from the raw checkin files again
            plan = expand_visits(counter.input(spark.read.format(fmt).load(f"{run_dir}/checkin")))
        else:
            # Only this step's input carries the observation; malformed lines are counted as
            # read, then dropped (never written as rows of NULLs).
            parsed = counter.input(raw[name]).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
            plan = curate({**clean, name: parsed}, p)[name]
        if buckets and name == "business":
            write_bucketed(counter.output(plan), f"{run_dir}/{name}", f"{table_prefix}_{name}", "business_id", buckets, fmt)
        elif by_period and name in DATED:
            parted = with_periods(counter.output(plan), DATED[name])
            # months are spread over tasks by a salt that follows the rows, so that a hot month is not one task
            plain = [f.name for f in parted.schema.fields if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType))]
            salt = F.pmod(F.xxhash64(*plain), F.lit(MONTH_TASKS))
            write_layer(parted.repartition(YEAR, MONTH, salt), f"{run_dir}/{name}", fmt=fmt, partition_by=[YEAR, MONTH])
        else:
            write_layer(counter.output(plan), f"{run_dir}/{name}", fmt=fmt)
        return counter

    done: dict[str, StepCounter] = {}
    # users first: the written user layer is the sampled key set, so the referential filters of
    # reviews and tips read its key column instead of parsing the raw user files again
    # (sampling it again inside ``curate`` is idempotent).
    if "user" in outputs:
        done["user"] = step("user")
        keys = spark.read.format(fmt).load(f"{run_dir}/user").select("user_id")
        clean["user"] = keys
    # the other layers are independent jobs: submitted together, the scheduler overlaps them
    middle = [n for n in outputs if n not in ("user", "visit")]
    if middle:
        with ThreadPoolExecutor(max_workers=len(middle)) as pool:
            done.update(zip(middle, pool.map(step, middle)))
    if "visit" in outputs:  # needs the written checkin layer
        done["visit"] = step("visit")
    if buckets:
        facts = {"review": ("review_cube", lambda df: review_cube(parse_dates(df))), "visit": ("visit_cube", visit_cube)}
        for name, (cube, aggregate) in facts.items():
            if name in outputs:
                rows = aggregate(spark.read.format(fmt).load(f"{run_dir}/{name}"))
                write_bucketed(rows, f"{run_dir}/{cube}", f"{table_prefix}_{cube}", "business_id", buckets, fmt)
    cubes = [cube for name, (cube, _) in facts.items() if name in outputs] if buckets else []
    store.replace({name: f"{run_dir}/{name}" for name in [*outputs, *cubes]})
    store.expire()
    counters = [done[n] for n in outputs if n in done]
    return step_summary(spark, counters)


def parse_dates(df: DataFrame) -> DataFrame:
    """The text ``date`` column as ``timestamp_ntz`` (NULL when it does not parse)."""
    return df.withColumn("date", as_timestamp(df, "date"))


def curated_specs(base_dir: str, fmt: str = "parquet", long_visits: bool = True) -> dict[str, SourceSpec]:
    """Source specs for the analytics views over curated layers.

    Visits come from the typed long-form ``visit`` layer written by the curation; with
    ``long_visits=False`` (layers from elsewhere) the packed ``checkin`` layer is expanded on read.
    """

    def layer(name: str, normalize=None) -> SourceSpec:
        return SourceSpec(fmt, normalize=normalize, read=lambda spark: read_layer(spark, base_dir, name, fmt).drop(YEAR, MONTH))

    return {
        "business": layer("business"),
        "reviews": layer("review", parse_dates),
        "tips": layer("tip"),
        "users": layer("user"),
        "checkins": layer("visit") if long_visits else layer("checkin", expand_visits),
    }

"""Full history of slowly changing entities from periodic snapshots.

Every entity's observations, one per release that has it, form one sorted array of structs. A higher-order fold
appends a version only where a tracked value changed or the entity had been away, and moves the end of the last
version otherwise; the folded versions are then exploded.

Defined results: null differs from the empty string; an entity missing from a release ends on that release's day;
repeated rows count once (of differing rows of one entity in one load the least is taken); rows with a null key and
releases without a valid start date are left out; an empty snapshot table leaves the old history as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from punctual.session import cut


@dataclass(frozen=True)
class Tracked:
    """An entity: its key, the columns whose changes make a version, and the surrogate key's name."""

    key: str
    columns: tuple[str, ...]
    surrogate: str


ROUTES = Tracked(
    "route_id",
    ("agency_id", "route_short_name", "route_long_name", "route_desc", "route_type", "route_url", "route_color", "route_text_color"),
    "route_sk",
)
STOPS = Tracked(
    "stop_id",
    ("stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon", "zone_id", "location_type", "parent_station", "wheelchair_boarding"),
    "stop_sk",
)


def attr_hash(columns: tuple[str, ...] | list[str]) -> Column:
    """SHA-256 over the columns, with separators that keep null and empty apart."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]), 256)


def releases_in_force(feed_info: DataFrame, old: DataFrame) -> DataFrame:
    """(start, feed_version), one row per start day; of versions with one start the latest loaded counts.

    Release dates that only the old history knows are added, as loaded before all others.
    """
    start = F.expr("try_to_timestamp(feed_start_date, 'yyyyMMdd')").cast("date")
    loads = feed_info.select(start.alias("start"), "feed_version", F.col("_loaded_at").alias("loaded"))
    never = F.lit(None).cast("timestamp").alias("loaded")
    dates = old.select(F.col("valid_from").alias("start"), "feed_version", never).unionByName(
        old.select(F.col("valid_to").alias("start"), F.lit(None).cast("string").alias("feed_version"), never)
    )
    rows = loads.unionByName(dates).where("start is not null")
    latest = F.max(F.struct(F.col("loaded").isNotNull(), "loaded", F.col("feed_version").isNotNull(), "feed_version")).alias("r")
    return rows.groupBy("start").agg(latest).select("start", "r.feed_version")


def applied_releases(feed_info: DataFrame, old: DataFrame, loads: DataFrame) -> DataFrame:
    """(start, until, feed_version, fresh) of the releases that make the history; ``fresh`` if ``loads`` has the version.

    Of releases without a snapshot those count that the old history reaches to. One row per day on which a release
    begins, so the window without a partition is over days of the calendar, however large the tables are.
    """
    given = loads.select("feed_version").distinct().withColumn("fresh", F.lit(True))
    reach = old.agg(F.greatest(F.max("valid_from"), F.max("valid_to")).alias("d"))
    force = releases_in_force(feed_info, old).join(given, "feed_version", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    applied = force.where(F.col("fresh") | (F.col("start") <= reach.scalar()))
    return applied.withColumn("until", F.lead("start").over(W.orderBy("start")))


def full_history(old: DataFrame, snapshots: DataFrame, feed_info: DataFrame, spec: Tracked) -> DataFrame:
    """All versions, old and new: key, tracked columns, attr_hash, feed_version, valid_from, surrogate, valid_to, is_current."""
    snapshots = snapshots.where(F.col(spec.key).isNotNull())
    # A version loaded again replaces its earlier rows, also those that the old history was built from.
    loads = snapshots.groupBy("feed_version").agg(F.max("_loaded_at").alias("_loaded_at"))
    releases = cut(applied_releases(feed_info, old, loads))
    tracked = F.struct(*spec.columns).alias("attrs")
    fresh = releases.where("fresh").join(loads, "feed_version").select("feed_version", "_loaded_at", "start", "until")
    new = (
        snapshots.join(fresh, ["feed_version", "_loaded_at"])
        .groupBy(spec.key, "start", "until", "feed_version")
        .agg(F.min(tracked).alias("attrs"))
        .select(spec.key, F.struct("start", "until", F.lit(False).alias("begins"), "feed_version", "attrs").alias("o"))
    )
    # The days that the old history stands for, as one sorted array; each old version takes its own slice of it.
    kept = releases.where("not fresh").agg(F.array_sort(F.collect_list(F.struct("start", "until"))).alias("days"))
    ends = F.col("valid_to")
    covered = F.filter("days", lambda r: (r["start"] >= F.col("valid_from")) & (ends.isNull() | (r["start"] < ends)))
    before = old.where(F.col(spec.key).isNotNull()).withColumn("days", kept.scalar()).select(
        spec.key, F.explode(covered).alias("r"), "valid_from", "feed_version", tracked
    )
    obs = new.unionByName(
        before.select(
            spec.key, F.struct("r.start", "r.until", (F.col("r.start") == F.col("valid_from")).alias("begins"), "feed_version", "attrs").alias("o")
        )
    )
    # One entity has at most one observation per release, so its array is bounded by the number of releases.
    arrays = obs.groupBy(spec.key).agg(F.array_sort(F.collect_set("o")).alias("seen"))

    def version(o: Column, until: Column) -> Column:
        return F.struct(o["start"].alias("start"), until.alias("until"), o["feed_version"].alias("feed_version"), o["attrs"].alias("attrs"))

    def step(done: Column, o: Column) -> Column:
        last = F.element_at(done, -1)
        same = (F.size(done) > 0) & last["until"].eqNullSafe(o["start"]) & ~o["begins"] & last["attrs"].eqNullSafe(o["attrs"])
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(version(last, o["until"])))
        return F.when(F.coalesce(same, F.lit(False)), longer).otherwise(F.concat(done, F.array(version(o, o["until"]))))

    none = F.slice(F.transform("seen", lambda o: version(o, o["until"])), 1, 0)
    folded = arrays.select(spec.key, F.explode(F.aggregate("seen", none, step)).alias("v"))
    versions = folded.select(
        spec.key, *[F.col(f"v.attrs.{c}").alias(c) for c in spec.columns], F.col("v.feed_version").alias("feed_version"),
        F.col("v.start").alias("valid_from"), F.col("v.until").alias("valid_to"),
    )
    sk = old.where(F.col(spec.key).isNotNull()).groupBy(spec.key, "valid_from").agg(F.max(spec.surrogate).alias("_sk"))
    return (
        versions.join(sk, [spec.key, "valid_from"], "left")
        .withColumn("attr_hash", attr_hash(spec.columns))
        .withColumn(spec.surrogate, F.coalesce("_sk", F.xxhash64(spec.key, "valid_from")))
        .withColumn("is_current", F.col("valid_to").isNull())
        .select(spec.key, *spec.columns, "attr_hash", "feed_version", "valid_from", spec.surrogate, "valid_to", "is_current")
    )

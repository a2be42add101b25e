"""Feeds as declarations: where each column lies in a message, how it is read, and what makes a row unusable."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.functions import scalars as S

FUTURE_SKEW_S = 300
TEXT, WHOLE, REAL, WHEN, DAY, COUNT = "text", "whole", "real", "when", "day", "count"
_READ: dict[str, Callable[[Column], Column]] = {
    TEXT: lambda c: c.cast("string"), WHOLE: S.whole_number, REAL: S.real_number, WHEN: S.epoch_instant, DAY: S.compact_date,
}
# Shapes of the two feeds' messages, every leaf a string.
_TRIP = "trip_id string, route_id string, direction_id string, start_time string, start_date string, schedule_relationship string"
_VEHICLE = "id string, label string, license_plate string"
_EVENT = "struct<delay:string, time:string, uncertainty:string>"
POSITION_SHAPE = (
    f"struct<id: string, vehicle: struct<trip: struct<{_TRIP}>, vehicle: struct<{_VEHICLE}>, "
    "position: struct<latitude: string, longitude: string, bearing: string, odometer: string, speed: string>, "
    "current_stop_sequence: string, stop_id: string, current_status: string, timestamp: string, congestion_level: string, "
    "occupancy_status: string>>"
)
UPDATE_SHAPE = (
    f"struct<id: string, trip_update: struct<trip: struct<{_TRIP}>, vehicle: struct<{_VEHICLE}>, "
    f"stop_time_update: array<struct<stop_sequence: string, stop_id: string, arrival: {_EVENT}, departure: {_EVENT}, "
    "schedule_relationship: string>>, timestamp: string, delay: string>>"
)


@dataclass(frozen=True)
class Feed:
    """A feed: the message's body, its fields as (column, path, reader), the key, and rules as (reason, condition).

    ``order`` is the column order of the typed table.
    """

    name: str
    body: str
    shape: str
    fields: tuple[tuple[str, str, str], ...]
    key: tuple[str, ...]
    rules: Callable[[], list[tuple[str, Column]]]
    header_time: bool = False  # where a message has no time of its own, that of its snapshot counts
    with_age: bool = False
    order: tuple[str, ...] = ()


def as_message(bronze: DataFrame, shape: str) -> DataFrame:
    """``entity`` as a struct, parsed where it is JSON text.

    Rows are filtered by what comes out of a message. So that the filter isn't moved below the parser, and each of its
    fields parsed for again, the parser stands behind a condition on the row's number, which always holds.
    """
    if isinstance(bronze.schema["entity"].dataType, T.StringType):
        return bronze.withColumn("entity", F.when(F.monotonically_increasing_id() >= 0, F.from_json("entity", shape)))
    return bronze


def typed(bronze: DataFrame, feed: Feed) -> DataFrame:
    """The feed's rows, flat and typed, with ``_dq_reason``: the first rule a row breaks, or null.

    Fields that the data has never had are null columns.
    """
    rows = as_message(bronze, feed.shape)

    def read(path: str, kind: str) -> Column:
        full = f"entity.{feed.body}.{path}"
        if kind == COUNT:
            is_list = isinstance(S.field_type(rows.schema, full), T.ArrayType)
            return F.when(F.col(full).isNotNull(), F.size(full)) if is_list else F.lit(None).cast("int")
        return _READ[kind](S.member(rows.schema, full))

    columns = {name: read(path, kind) for name, path, kind in feed.fields}
    header = S.epoch_instant(F.col("feed_header_ts"))
    if feed.header_time:
        columns["event_ts"] = F.coalesce(columns["event_ts"], header)
    columns |= {
        "service_date": S.service_day(columns["trip_start_date"], columns["event_ts"]),
        "feed_header_ts": header, "fetched_at": S.instant(F.col("fetched_at")),
        "_source_file": F.col("_source_file"), "_ingested_at": F.col("_ingested_at"),
    }
    if feed.with_age:
        columns["staleness_s"] = F.unix_seconds(columns["fetched_at"]) - F.unix_seconds(columns["event_ts"])
    names = feed.order or tuple(columns)
    return rows.select(*[columns[n].alias(n) for n in names]).withColumn("_dq_reason", S.first_reason(feed.rules()))


def valid(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("_dq_reason").isNull()).drop("_dq_reason")


def quarantined(rows: DataFrame, feed: str) -> DataFrame:
    """The unusable rows, whole as JSON, so rows of any feed fit one table."""
    kept = [c for c in rows.columns if c != "_dq_reason"]
    return rows.where(F.col("_dq_reason").isNotNull()).select(
        F.lit(feed).alias("feed"), F.col("_dq_reason").alias("reason"), F.to_json(F.struct(*kept)).alias("record"), "_source_file",
        F.current_timestamp().alias("_quarantined_at"),
    )


def _ahead() -> Column:
    return F.unix_seconds("fetched_at") - F.unix_seconds("event_ts") < -FUTURE_SKEW_S


def position_rules() -> list[tuple[str, Column]]:
    lat, lon = F.col("latitude"), F.col("longitude")
    return [
        ("missing_vehicle_id", S.is_blank(F.col("vehicle_id"))),
        ("missing_or_bad_timestamp", F.col("event_ts").isNull()),
        ("missing_position", lat.isNull() | lon.isNull()),
        ("invalid_position", ~lat.between(-90, 90) | ~lon.between(-180, 180) | ((lat == 0) & (lon == 0))),
        ("timestamp_in_future", _ahead()),
    ]


def update_rules() -> list[tuple[str, Column]]:
    return [
        ("missing_trip_id", S.is_blank(F.col("trip_id"))),
        ("missing_or_bad_timestamp", F.col("event_ts").isNull()),
        ("timestamp_in_future", _ahead()),
    ]


POSITIONS = Feed(
    name="vehicle_positions", body="vehicle", shape=POSITION_SHAPE, key=("vehicle_id", "event_ts"), rules=position_rules, with_age=True,
    fields=(
        ("vehicle_id", "vehicle.id", TEXT), ("event_ts", "timestamp", WHEN), ("route_id", "trip.route_id", TEXT),
        ("trip_id", "trip.trip_id", TEXT), ("direction_id", "trip.direction_id", WHOLE), ("trip_start_date", "trip.start_date", DAY),
        ("trip_start_time", "trip.start_time", TEXT), ("vehicle_label", "vehicle.label", TEXT), ("current_status", "current_status", TEXT),
        ("stop_id", "stop_id", TEXT), ("current_stop_sequence", "current_stop_sequence", WHOLE), ("latitude", "position.latitude", REAL),
        ("longitude", "position.longitude", REAL), ("bearing", "position.bearing", REAL), ("speed_mps", "position.speed", REAL),
        ("occupancy_status", "occupancy_status", TEXT),
    ),
    order=(
        "vehicle_id", "event_ts", "service_date", "route_id", "trip_id", "direction_id", "trip_start_date", "trip_start_time",
        "vehicle_label", "current_status", "stop_id", "current_stop_sequence", "latitude", "longitude", "bearing", "speed_mps",
        "occupancy_status", "staleness_s", "feed_header_ts", "fetched_at", "_source_file", "_ingested_at",
    ),
)
UPDATES = Feed(
    name="trip_updates", body="trip_update", shape=UPDATE_SHAPE, key=("trip_id", "trip_start_date", "event_ts"), rules=update_rules,
    header_time=True,
    fields=(
        ("trip_id", "trip.trip_id", TEXT), ("event_ts", "timestamp", WHEN), ("route_id", "trip.route_id", TEXT),
        ("direction_id", "trip.direction_id", WHOLE), ("trip_start_date", "trip.start_date", DAY), ("trip_start_time", "trip.start_time", TEXT),
        ("schedule_relationship", "trip.schedule_relationship", TEXT), ("vehicle_id", "vehicle.id", TEXT), ("delay_s", "delay", WHOLE),
        ("n_stop_time_updates", "stop_time_update", COUNT),
    ),
    order=(
        "trip_id", "event_ts", "service_date", "route_id", "direction_id", "trip_start_date", "trip_start_time", "schedule_relationship",
        "vehicle_id", "delay_s", "n_stop_time_updates", "feed_header_ts", "fetched_at", "_source_file", "_ingested_at",
    ),
)
FEEDS = {f.name: f for f in (POSITIONS, UPDATES)}


def reconcile(bronze: DataFrame, silver: DataFrame, feed: Feed) -> dict:
    """Where every raw row went: quarantined, duplicate, dropped late, or silver. One pass over the raw rows."""
    rows = typed(bronze, feed)
    good = F.col("_dq_reason").isNull()
    key = F.struct(*feed.key)
    seen = rows.agg(
        F.count("*").alias("bronze_rows"), F.count_if(good).alias("valid"), F.count_distinct(F.when(good, F.to_json(key, {"ignoreNullFields": "false"}))).alias("keys")
    ).first()
    kept = silver.count()
    duplicates = seen.valid - seen["keys"]
    return {
        "bronze_rows": seen.bronze_rows, "quarantined": seen.bronze_rows - seen.valid, "duplicates": duplicates,
        "dropped_late": seen["keys"] - kept, "silver_rows": kept,
        "pct_duplicates": round(100.0 * duplicates / seen.bronze_rows, 2) if seen.bronze_rows else 0.0,
    }

"""Landed lines to raw, typed and quarantined rows, as streams that run to their end."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from punctual.operators import feeds
from punctual.streaming import pipeline

HEADER = 1790000000


def vehicle(vid="1", ts=HEADER, lat="38.9", lon="-77.0", **more):
    body = {"timestamp": str(ts), "trip": {"trip_id": "t", "route_id": "70", "start_date": "20260921", "direction_id": "0"}, "vehicle": {"label": vid or ""}}
    if vid is not None:
        body["vehicle"]["id"] = vid
    if lat is not None:
        body["position"] = {"latitude": lat, "longitude": lon}
    return {"id": "x", "vehicle": body | more}


def update(trip="t", ts=HEADER, **more):
    return {"id": "x", "trip_update": {"trip": {"trip_id": trip, "start_date": "20260921"}, "timestamp": str(ts), "delay": "60", "stop_time_update": [{"stop_id": "A"}]} | more}


def record(entity, feed="vehicle_positions", fetched=HEADER + 5):
    at = datetime.fromtimestamp(fetched, UTC).isoformat()
    return {"feed": feed, "feed_header_ts": str(HEADER), "fetched_at": at, "entity": entity}


def land(tmp_path, n, *entities, feed="vehicle_positions", fetched=HEADER + 5):
    folder = tmp_path / "landing" / feed / "ingest_date=2026-09-21"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{feed}_{n}.jsonl").write_text("".join(json.dumps(record(e, feed, fetched)) + "\n" for e in entities))
    return f"file://{tmp_path}/landing/{feed}"


def raw(spark, *entities, feed="vehicle_positions", as_text=False, fetched=HEADER + 5):
    lines = [json.dumps(record(json.dumps(e) if as_text else e, feed, fetched)) for e in entities]
    df = spark.read.option("primitivesAsString", True).json(spark.createDataFrame([(x,) for x in lines], "value string").rdd.map(lambda r: r.value))
    return df.select("*", F.lit("f").alias("_source_file"), F.lit(datetime(2026, 9, 21)).alias("_ingested_at"))


@pytest.mark.parametrize(
    ("entity", "reason"),
    [
        (vehicle(None), "missing_vehicle_id"), (vehicle(" "), "missing_vehicle_id"), (vehicle(ts="soon"), "missing_or_bad_timestamp"),
        (vehicle(lat=None), "missing_position"), (vehicle(lat="0", lon="0"), "invalid_position"), (vehicle(lat="91"), "invalid_position"),
        (vehicle(ts=HEADER + 1000), "timestamp_in_future"), (vehicle(), None),
    ],
)
@pytest.mark.parametrize("as_text", [False, True])
def test_reasons(spark, entity, reason, as_text):
    assert feeds.typed(raw(spark, entity, as_text=as_text), feeds.POSITIONS).first()["_dq_reason"] == reason


def test_a_message_is_parsed_once(spark):
    rows = feeds.valid(feeds.typed(raw(spark, vehicle(), as_text=True), feeds.POSITIONS))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_updates(spark):
    rows = feeds.typed(raw(spark, update(), update(trip=None), update(ts="x"), feed="trip_updates"), feeds.UPDATES).collect()
    assert [r["_dq_reason"] for r in rows] == [None, "missing_trip_id", None]
    assert (rows[0].delay_s, rows[0].n_stop_time_updates) == (60, 1)
    assert rows[2].event_ts == datetime(2026, 9, 21, 14, 13, 20)  # the snapshot's own time


def test_types_and_columns(spark):
    r = feeds.typed(raw(spark, vehicle(current_stop_sequence="7")), feeds.POSITIONS)
    assert r.columns == [*feeds.POSITIONS.order, "_dq_reason"]
    row = r.first()
    assert (row.current_stop_sequence, row.latitude, row.staleness_s, str(row.service_date), row.occupancy_status) == (7, 38.9, 5, "2026-09-21", None)


def test_end_to_end(spark, lake, tmp_path):
    place = land(tmp_path, 1, vehicle("1"), vehicle("1"), vehicle("2"), vehicle(None))
    assert pipeline.ingest(lake, "vehicle_positions", place) == 4
    done = pipeline.refine(lake, "vehicle_positions")
    assert (done["bronze_rows_read"], done["silver_rows_added"], done["quarantine_rows_added"]) == (4, 2, 1)
    bad = lake.read("silver_quarantine").first()
    assert bad.reason == "missing_vehicle_id" and "vehicle_id" not in json.loads(bad.record)
    # Nothing new: nothing is read.
    assert pipeline.ingest(lake, "vehicle_positions", place) == 0
    assert set(pipeline.refine(lake, "vehicle_positions").values()) == {0}
    # A repeat of an old ping long after, and a new vehicle with a field not seen before.
    land(tmp_path, 2, vehicle("1"), vehicle("3", occupancy_status="FULL"), fetched=HEADER + 2400)
    assert pipeline.ingest(lake, "vehicle_positions", place) == 2
    assert pipeline.refine(lake, "vehicle_positions")["silver_rows_added"] == 1
    silver = lake.read("silver_vehicle_positions")
    assert {r.vehicle_id: r.occupancy_status for r in silver.collect()} == {"1": None, "2": None, "3": "FULL"}
    assert pipeline.reconcile(lake, "vehicle_positions") == {
        "bronze_rows": 6, "quarantined": 1, "duplicates": 2, "dropped_late": 0, "silver_rows": 3, "pct_duplicates": 33.33
    }
    # The stream's memory is lost: all is read again and nothing added.
    pipeline._delete(lake, pipeline.checkpoint(lake, "silver_vehicle_positions"))
    again = pipeline.refine(lake, "vehicle_positions")
    assert (again["bronze_rows_read"], again["silver_rows_added"]) == (6, 0)
    # The table is lost and the stream's memory isn't.
    lake.drop("silver_vehicle_positions")
    with pytest.raises(pipeline.TableLost):
        pipeline.refine(lake, "vehicle_positions")
    pipeline.reset(lake)
    assert pipeline.refine(lake, "vehicle_positions")["silver_rows_added"] == 3


def test_late_rows_are_dropped_and_counted(spark, lake, tmp_path):
    place = land(tmp_path, 1, vehicle("1"))
    pipeline.ingest(lake, "vehicle_positions", place)
    pipeline.refine(lake, "vehicle_positions", "10 minutes")
    land(tmp_path, 2, vehicle("2", HEADER - 1200), vehicle("3", HEADER - 300))
    pipeline.ingest(lake, "vehicle_positions", place)
    assert pipeline.refine(lake, "vehicle_positions", "10 minutes")["dropped_late"] == 1
    assert {r.vehicle_id for r in lake.read("silver_vehicle_positions").collect()} == {"1", "3"}
    assert pipeline.reconcile(lake, "vehicle_positions")["dropped_late"] == 1


def test_line_that_does_not_fit_is_kept(spark, lake, tmp_path):
    place = land(tmp_path, 1, vehicle("1"))
    pipeline.ingest(lake, "vehicle_positions", place)
    (tmp_path / "landing/vehicle_positions/ingest_date=2026-09-21/b.jsonl").write_text('{"feed": broken\n')
    pipeline.ingest(lake, "vehicle_positions", place)
    assert [r._rescued for r in lake.read("bronze_vehicle_positions").where("_rescued is not null").collect()] == ['{"feed": broken']


def test_unknown_feed(lake):
    with pytest.raises(ValueError):
        pipeline.refine(lake, "alerts")

import json
import zipfile
from datetime import UTC, date, datetime
from types import SimpleNamespace

import pytest

from punctual.sources import feed_api, snapshot, static_release, weather_api, wire
from punctual.sources.store import HadoopStore


class Web:
    """Answers from a script: statuses, bodies or exceptions."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def get(self, url, **options):
        self.asked.append(url)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        if isinstance(a, int):
            return SimpleNamespace(status_code=a, content=b"")
        return SimpleNamespace(status_code=200, content=a, json=lambda: json.loads(a), raise_for_status=lambda: None)


def test_retries():
    waits = []
    assert feed_api.fetch(Web(429, OSError("reset"), 503, b"ok"), "u", "k", waits.append) == b"ok"
    assert waits == [2, 4, 8]
    with pytest.raises(RuntimeError):
        feed_api.fetch(Web(500, 500, 500, 500), "u", "k", waits.append)
    for status in (401, 403, 404):
        web = Web(status, b"never")
        with pytest.raises(feed_api.Refused):
            feed_api.fetch(web, "u", "k", waits.append)
        assert len(web.asked) == 1


def message(ts=1790000000, n=2):
    return json.dumps({"header": {"timestamp": str(ts)}, "entity": [{"id": str(k)} for k in range(n)]}).encode()


def binary():
    """Version 2.0 at 1790000000, and a vehicle "x" at (1.5, -2.25) on route 70 that is stopped, written out byte by byte."""
    time = bytes([0x18]) + bytes([0x80, 0xAB, 0xC5, 0xD5, 0x06])  # field 3, a number in groups of seven bits
    header = b"\x0a\x032.0" + time
    trip = b"\x2a\x0270" + b"\x30\x01"
    place = b"\x0d\x00\x00\xc0\x3f" + b"\x15\x00\x00\x10\xc0"
    vehicle = b"\x0a" + bytes([len(trip)]) + trip + b"\x12" + bytes([len(place)]) + place + b"\x20\x01" + b"\xfa\x3f\x01z"
    entity = b"\x0a\x01x" + b"\x22" + bytes([len(vehicle)]) + vehicle
    return b"\x0a" + bytes([len(header)]) + header + b"\x12" + bytes([len(entity)]) + entity


def test_binary_messages():
    at = sum((b & 0x7F) << 7 * n for n, b in enumerate([0x80, 0xAB, 0xC5, 0xD5, 0x06]))
    want = {"header": {"gtfs_realtime_version": "2.0", "timestamp": str(at)}, "entity": [{"id": "x", "vehicle": {
        "trip": {"route_id": "70", "direction_id": 1}, "position": {"latitude": 1.5, "longitude": -2.25}, "current_status": "STOPPED_AT"}}]}
    assert wire.decode(binary()) == want  # field 1023 isn't known and is skipped
    assert wire.decode(wire.encode(want)) == want
    update = {"header": {"timestamp": "1"}, "entity": [{"id": "u", "trip_update": {
        "trip": {"trip_id": "t", "schedule_relationship": "CANCELED"}, "delay": -90, "timestamp": "18446744073709551615",
        "stop_time_update": [{"stop_sequence": 3, "arrival": {"time": "-5", "delay": 2147483647}}, {"stop_id": "A", "schedule_relationship": 77}]}}]}
    assert wire.decode(wire.encode(update)) == update and wire.decode(b"") == {}
    assert wire.decode(wire.encode({"entity": [{"id": "p", "vehicle": {"position": {"latitude": 38.9072, "longitude": -77.0369}}}]}))["entity"][0]["vehicle"]["position"] == {"latitude": 38.9072, "longitude": -77.0369}
    for bad in (binary()[:-1], b"\x0b", b"\x0a", b"\x80" * 11, b"\x08\x01"):
        with pytest.raises(ValueError):
            wire.decode(bad)


def test_binary_snapshots_as_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.pb").write_bytes(binary())
    (tmp_path / "in/b.pb").write_bytes(b"")
    (row,) = wire.read_snapshots(spark, f"file://{tmp_path}/in", "vehicle_positions").collect()
    assert row.feed == "vehicle_positions" and json.loads(row.entity)["vehicle"]["current_status"] == "STOPPED_AT" and row._source_file.endswith("a.pb")


def test_polling_binary_feeds_to_shared_storage(spark, tmp_path):
    s = settings(tmp_path / "here", vehicle_positions="p")
    mirror = feed_api.Mirror(HadoopStore(spark), tmp_path / "here", f"file://{tmp_path}/there")
    assert feed_api.poll_once(Web(binary()), s, wire.decode, mirror) == {"vehicle_positions": 1}
    (line,) = spark.read.json(f"file://{tmp_path}/there/vehicle_positions").collect()
    assert line.entity.vehicle.position.latitude == 1.5 and [p.name for p in (tmp_path / "there").rglob("*.part")] == []


def settings(tmp_path, **urls):
    return feed_api.Settings("k", urls or {"positions": "p"}, tmp_path, 0.0)


def test_polling_lands_each_snapshot_once(tmp_path):
    s = settings(tmp_path, positions="p", updates="u")
    web = Web(message(), 401, message(), message(n=1))
    assert feed_api.poll_once(web, s, json.loads) == {"positions": 2, "updates": -1}
    assert feed_api.poll_once(web, s, json.loads) == {"positions": 0, "updates": 1}
    file = tmp_path / "positions/ingest_date=2026-09-21/positions_1790000000.jsonl"
    lines = [json.loads(x) for x in file.read_text().splitlines()]
    assert [x["entity"]["id"] for x in lines] == ["0", "1"] and set(lines[0]) == {"feed", "feed_header_ts", "fetched_at", "entity"}
    with pytest.raises(RuntimeError):
        feed_api.poll(Web(401), settings(tmp_path), json.loads, 1)


def test_failed_landing_leaves_nothing(tmp_path):
    def rows():
        yield {"a": 1}
        raise OSError("disk full")

    with pytest.raises(OSError):
        feed_api.land(tmp_path / "x.jsonl", rows())
    assert not list(tmp_path.iterdir())


def test_mirror(tmp_path):
    sent = {}
    store = SimpleNamespace(upload=lambda path, content, overwrite: sent.update({path: content.read()}))
    (tmp_path / "a").mkdir()
    (tmp_path / "a/b.jsonl").write_text("x")
    assert feed_api.Mirror(store, tmp_path, "/raw/").copy(tmp_path / "a/b.jsonl") == "/raw/a/b.jsonl" and sent == {"/raw/a/b.jsonl": b"x"}


def test_settings():
    s = feed_api.Settings.from_environment({"FEED_API_KEY": "k", "FEED_URL_POSITIONS": "p", "POLL_INTERVAL_S": "5"})
    assert (s.urls, s.interval_s) == ({"positions": "p"}, 5.0)
    with pytest.raises(ValueError):
        feed_api.Settings.from_environment({})


def archive(path, info="feed_publisher_name,feed_version\nX,v7\n", **files):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("feed_info.txt", info)
        for name, text in files.items():
            z.writestr(name.replace("__", "/").replace("_txt", ".txt"), text)
    return path


def test_release(spark, lake, tmp_path):
    z = archive(tmp_path / "a.zip", "﻿feed_publisher_name,feed_version\nX, v7 \n", ________evil_txt="a\n1\n", stop_times_txt="trip_id,stop_id,stop_sequence,arrival_time,departure_time\nt,070,1, 8:05:09 ,25:10:00\nt,071,x,abc,\n", readme_md="no")
    assert static_release.version_of(z) == "v7"
    done = static_release.load(lake, z, tmp_path / "out")
    assert done == {"static_evil": 1, "static_feed_info": 1, "static_stop_times": 2}
    assert sorted(p.name for p in (tmp_path / "out/v7").iterdir()) == ["evil.txt", "feed_info.txt", "stop_times.txt"]
    assert static_release.load(lake, z, tmp_path / "out") == done  # in place of itself
    assert static_release.build_stop_times(lake, "v7") == 2
    rows = sorted(map(tuple, lake.read("silver_stop_times").select("stop_id", "stop_sequence", "arrival_secs", "departure_secs", "timepoint").collect()))
    assert rows == [("070", 1, 29109, 90600, None), ("071", None, None, None, None)]
    with pytest.raises(ValueError):
        static_release.version_of(archive(tmp_path / "b.zip", "feed_publisher_name,feed_version\nX,\n"))
    with pytest.raises(ValueError):
        static_release.build_stop_times(lake, "v7' or 1=1")


WEATHER = {"hourly": {"time": ["2026-10-01T03:00", "2026-10-01T14:00", "2026-10-01T15:00", "2026-10-01T23:00"], "temperature_2m": [1.0, 2.0, 3.0, 4.0], "precipitation": [0.1, 0.0, None, 5.0], "weather_code": [1, 2, 3, 4]}}


def test_weather(spark, lake):
    rows = {str(r.hour_utc): (str(r.local_date), r.local_hour, r.is_wet, r.rain_mm) for r in weather_api.hours(spark, WEATHER, datetime(2026, 10, 1, 20)).collect()}
    assert rows == {"2026-10-01 03:00:00": ("2026-09-30", 23, True, None), "2026-10-01 14:00:00": ("2026-10-01", 10, False, None)}
    assert weather_api.window(date(2026, 10, 1)) == (date(2026, 9, 30), date(2026, 10, 2))
    web = Web(json.dumps(WEATHER).encode(), json.dumps(WEATHER).encode())
    now = datetime(2026, 10, 1, 20, tzinfo=UTC)
    assert [weather_api.load(lake, web, now) for _ in range(2)] == [{"hours": 2}] * 2
    assert lake.read("silver_weather_hourly").count() == 2


def test_snapshot_fetch(tmp_path):
    def files(**bodies):
        body = lambda p: SimpleNamespace(contents=SimpleNamespace(read=lambda: bodies[p.split("/")[-1].split(".")[0]]))
        return SimpleNamespace(download=body)

    manifest = json.dumps({"rows": {"daily": 1}}).encode()
    assert set(snapshot.fetch(files(manifest=manifest, daily=b"a,b\n1,2\n"), "s", tmp_path)) == {"manifest.json", "daily.csv"}
    for bad in (files(manifest=b"<!DOCTYPE html>", daily=b""), files(manifest=b"[1]", daily=b""), files(manifest=manifest, daily=b"<html>")):
        with pytest.raises(ValueError):
            snapshot.fetch(bad, "s", tmp_path)
    assert (tmp_path / "daily.csv").read_bytes() == b"a,b\n1,2\n"  # nothing was replaced


def test_entity_kinds(spark):
    lines = spark.createDataFrame([(("1", "x", None),), (("2", None, "y"),), (("3", None, None),)], "entity struct<id: string, vehicle: string, trip_update: string>")
    assert {r.kind: r.n for r in snapshot.entity_kinds(lines).collect()} == {"vehicle": 1, "trip_update": 1, "other": 1}


def test_web_session():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from punctual.sources.web import WebSession

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            code = 200 if "a=1" in self.path and self.headers["api_key"] == "k" else 404
            self.send_response(code)
            self.end_headers()
            self.wfile.write(b'{"x": 1}')

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/f"
        ok = WebSession().get(url, headers={"api_key": "k"}, params={"a": 1})
        assert (ok.status_code, ok.json()) == (200, {"x": 1})
        bad = WebSession().get(url)
        assert bad.status_code == 404
        with pytest.raises(RuntimeError):
            bad.raise_for_status()
        with pytest.raises(feed_api.Refused):
            feed_api.fetch(WebSession(), url, "wrong")
    finally:
        server.shutdown()
        server.server_close()
    with pytest.raises(OSError):
        WebSession().get(url, timeout=1)


def test_views(spark, lake):
    from punctual.plans import views

    assert views.publish(lake) == {}
    lake.overwrite("silver_weather_hourly", weather_api.hours(spark, WEATHER))
    perf = spark.createDataFrame([(date(2026, 10, 1), "70", 10, 90.0), (date(2026, 10, 1), "70", 9, 80.0)], "service_date date, route_id string, hour_local int, pct_on_time double")
    lake.overwrite("gold_route_hour_performance", perf)
    assert list(views.publish(lake)) == ["gold_route_hour_weather"]
    rows = spark.table("gold_route_hour_weather").collect()
    assert [(r.hour_local, r.is_wet, r.pct_on_time) for r in rows] == [(10, False, 90.0)]  # hours without weather drop out

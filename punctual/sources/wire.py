"""The feeds' binary messages: protocol-buffer wire format to the JSON form of the same message, and back.

Only the public message layout is declared; decoding and encoding follow from it. In the JSON form 64-bit integers are
text and enum values are names, fields that a message doesn't have are absent, and fields that the layout doesn't know
are skipped.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The public realtime layout; a field is number, name and kind, with * if it comes more than once.
LAYOUT = {
    "message": "1 header header, 2 entity entity*",
    "header": "1 gtfs_realtime_version string, 2 incrementality incrementality, 3 timestamp uint64, 4 feed_version string",
    "entity": "1 id string, 2 is_deleted bool, 3 trip_update trip_update, 4 vehicle position_of_vehicle",
    "trip_update": "1 trip trip, 2 stop_time_update stop_time_update*, 3 vehicle vehicle, 4 timestamp uint64, 5 delay int32",
    "stop_time_update": "1 stop_sequence uint32, 2 arrival stop_event, 3 departure stop_event, 4 stop_id string, 5 schedule_relationship stop_relationship",
    "stop_event": "1 delay int32, 2 time int64, 3 uncertainty int32",
    "position_of_vehicle": "1 trip trip, 2 position position, 3 current_stop_sequence uint32, 4 current_status stop_status, 5 timestamp uint64, "
    "6 congestion_level congestion, 7 stop_id string, 8 vehicle vehicle, 9 occupancy_status occupancy, 10 occupancy_percentage uint32",
    "position": "1 latitude float, 2 longitude float, 3 bearing float, 4 odometer double, 5 speed float",
    "trip": "1 trip_id string, 2 start_time string, 3 start_date string, 4 schedule_relationship trip_relationship, 5 route_id string, 6 direction_id uint32",
    "vehicle": "1 id string, 2 label string, 3 license_plate string",
}
ENUMS = {
    "incrementality": {0: "FULL_DATASET", 1: "DIFFERENTIAL"},
    "stop_status": {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"},
    "congestion": {0: "UNKNOWN_CONGESTION_LEVEL", 1: "RUNNING_SMOOTHLY", 2: "STOP_AND_GO", 3: "CONGESTION", 4: "SEVERE_CONGESTION"},
    "occupancy": {
        0: "EMPTY", 1: "MANY_SEATS_AVAILABLE", 2: "FEW_SEATS_AVAILABLE", 3: "STANDING_ROOM_ONLY", 4: "CRUSHED_STANDING_ROOM_ONLY", 5: "FULL",
        6: "NOT_ACCEPTING_PASSENGERS", 7: "NO_DATA_AVAILABLE", 8: "NOT_BOARDABLE",
    },
    "trip_relationship": {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"},
    "stop_relationship": {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"},
}
_FIELDS = {
    name: {int(n): (field, kind.rstrip("*"), kind.endswith("*")) for n, field, kind in (x.split() for x in text.split(", "))} for name, text in LAYOUT.items()
}
VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5
_BITS = {"uint64": 64, "int64": 64, "uint32": 32, "int32": 32}


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(raw) or shift > 63:
            raise ValueError("message cut short")
        byte = raw[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _parts(raw: bytes) -> Iterator[tuple[int, int, object]]:
    """(field number, wire type, value) of each field."""
    at = 0
    while at < len(raw):
        tag, at = _varint(raw, at)
        wire = tag & 7
        if wire == VARINT:
            value, at = _varint(raw, at)
        elif wire in (FIXED64, FIXED32, BYTES):
            size, at = _varint(raw, at) if wire == BYTES else ({FIXED64: 8, FIXED32: 4}[wire], at)
            value, at = raw[at : at + size], at + size
            if at > len(raw):
                raise ValueError("message cut short")
        else:
            raise ValueError(f"wire type {wire} isn't known")
        yield tag >> 3, wire, value


def _value(kind: str, wire: int, value: object) -> object:
    wanted = VARINT if kind in _BITS or kind in ENUMS or kind == "bool" else FIXED32 if kind == "float" else FIXED64 if kind == "double" else BYTES
    if wire != wanted:
        raise ValueError(f"a field of kind {kind} has wire type {wire}")
    if kind in _BITS:
        bits = _BITS[kind]
        number = value & ((1 << bits) - 1)
        if kind.startswith("int") and number >> (bits - 1):
            number -= 1 << bits
        return str(number) if bits == 64 else number
    if kind in ENUMS:
        return ENUMS[kind].get(value, value)
    if kind == "bool":
        return bool(value)
    if kind == "float":  # the shortest decimal that gives the same 32 bits
        return float(str(np.frombuffer(value, "<f4")[0]))
    if kind == "double":
        return struct.unpack("<d", value)[0]
    return value.decode("utf-8") if kind == "string" else decode(value, kind)


def decode(raw: bytes, kind: str = "message") -> dict:
    """The JSON form of a message. A message that is cut short, or of another layout, is an error."""
    out: dict = {}
    for number, wire, value in _parts(raw):
        if number in _FIELDS[kind]:
            name, inner, many = _FIELDS[kind][number]
            got = _value(inner, wire, value)
            if many:
                out.setdefault(name, []).append(got)
            else:
                out[name] = got
    return out


def _number(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def encode(body: dict, kind: str = "message") -> bytes:
    """A message from its JSON form; None and unknown fields are left out."""
    out = bytearray()
    for number, (name, inner, many) in _FIELDS[kind].items():
        if body.get(name) is None:
            continue
        for value in body[name] if many else [body[name]]:
            if inner in _BITS or inner in ENUMS or inner == "bool":
                names = {v: k for k, v in ENUMS.get(inner, {}).items()}
                out += _number(number << 3 | VARINT) + _number(names[value] if value in names else int(value))
            elif inner in ("float", "double"):
                out += _number(number << 3 | (FIXED32 if inner == "float" else FIXED64)) + struct.pack("<f" if inner == "float" else "<d", float(value))
            else:
                raw = str(value).encode() if inner == "string" else encode(value, inner)
                out += _number(number << 3 | BYTES) + _number(len(raw)) + raw
    return bytes(out)


def decoded(snapshots: DataFrame, feed: str, content: str = "content", source: str = "path", fetched: str = "modificationTime") -> DataFrame:
    """Raw rows, one for each entity of each binary snapshot, with ``entity`` as JSON text; a snapshot is decoded in its task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, path, at in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                message = decode(raw.as_py())
                texts = [json.dumps(e, ensure_ascii=False, separators=(",", ":")) for e in message.get("entity", [])]
                same = lambda x: pa.array([x] * len(texts), pa.string())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [same(feed), same(message.get("header", {}).get("timestamp")), same(at), pa.array(texts, pa.string()), same(path)],
                    ["feed", "feed_header_ts", "fetched_at", "entity", "_source_file"],
                )

    text = snapshots.selectExpr(content, source, f"date_format({fetched}, \"yyyy-MM-dd'T'HH:mm:ssXXX\") as fetched_at")
    return text.mapInArrow(run, "feed string, feed_header_ts string, fetched_at string, entity string, _source_file string")


def read_snapshots(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Raw rows of the binary snapshot files below ``path``."""
    return decoded(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path), feed)

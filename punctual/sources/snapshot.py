"""Reading and fetching published snapshots (CSV files with a manifest)."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from pathlib import Path
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.session import shared_path

MANIFEST = "manifest.json"
# The datasets and the types of their columns; an id such as 070 is text.
_PLACE = "service_date date, route_id string, direction_id int, stop_id string"
SCHEMAS = {
    "route_summary": "route_id string, route_short_name string, route_long_name string, departures long, on_time long, early long, late long, "
    "avg_delay_s double, p90_delay_s double, rush_departures long, rush_on_time long, days long, headways long, bunched long, gapped long",
    "route_hour": "route_id string, day_type string, hour_local int, departures long, on_time long, late long, early long, delay_s_sum long, "
    "headways long, bunched long, gapped long",
    "daily": "service_date date, day_of_week string, departures long, on_time long, routes long, vehicles long, headways long, bunched long",
    "stops": "stop_id string, departures long, on_time long, avg_delay_s double, routes long, route_ids string, stop_name string, lat double, "
    "lon double, headways long, bunched long",
    "weather": "weather string, rush boolean, hours long, departures long, on_time long, avg_delay_s double",
    "bunching_example": f"{_PLACE}, stop_name string, trip_id string, vehicle_id string, scheduled_epoch long, observed_epoch long, delay_s int, "
    "headway_s int, sched_headway_s int, headway_status string",
    "pipeline_runs": "run_id string, step string, status string, started_epoch long, duration_s long, bronze_rows long, freshness_s int",
    "dq_checks": "check_name string, table_name string, severity string, runs long, passed long, rows_failed long, rows_checked long",
}


class Files(Protocol):
    def download(self, path: str) -> Any: ...


@dataclass
class Snapshot:
    """The manifest and the datasets by name; a dataset without a file is absent."""

    manifest: dict
    tables: dict[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def metrics(self) -> dict:
        return self.manifest.get("metrics") or {}


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns by name, with their pinned types; empty cells and what isn't of the type are null, further columns stay text."""
    rows = spark.read.option("header", True).option("nullValue", "").csv(path)
    pinned = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields}
    return rows.withColumns({c: F.col(c).try_cast(pinned[c]) for c in rows.columns if c in pinned})


def load(spark: SparkSession, folder: str | Path) -> Snapshot | None:
    """The snapshot in a folder of this machine; None without a manifest. Tasks read copies in the shared folder."""
    folder = Path(folder)
    if not (folder / MANIFEST).exists():
        return None
    files = {n: folder / f"{n}.csv" for n in SCHEMAS}
    hadoop, place, found = spark._jvm.org.apache.hadoop.fs, shared_path(spark, "snapshot"), {}
    for name, file in files.items():
        if file.exists():
            copy = hadoop.Path(f"{place}/{file.name}")
            fs = copy.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.copyFromLocalFile(False, True, hadoop.Path(file.absolute().as_uri()), copy)
            found[name] = read_csv(spark, copy.toString(), SCHEMAS[name])
    return Snapshot(json.loads((folder / MANIFEST).read_text(encoding="utf-8")), found)


def checked(name: str, body: bytes) -> None:
    """Refuses what isn't the file it should be: pages, empty bodies, a manifest that isn't an object."""
    start = body.lstrip()[:200].lower()
    if not start or start.startswith((b"<!doctype", b"<html")):
        raise ValueError(f"{name}: not a snapshot file")
    if name == MANIFEST:
        if not isinstance(json.loads(body), dict):
            raise ValueError(f"{name}: not an object")
    elif b"," not in body.split(b"\n", 1)[0]:
        raise ValueError(f"{name}: no header")


def fetch(files: Files, source: str, target: Path) -> dict[str, int]:
    """Copies a snapshot's files; all are fetched and checked before any is replaced. Bytes by name."""
    manifest = files.download(f"{source}/{MANIFEST}").contents.read()
    checked(MANIFEST, manifest)
    bodies = {}
    for name in json.loads(manifest).get("rows", {}):
        bodies[f"{name}.csv"] = files.download(f"{source}/{name}.csv").contents.read()
        checked(f"{name}.csv", bodies[f"{name}.csv"])
    target.mkdir(parents=True, exist_ok=True)
    for name, body in [*bodies.items(), (MANIFEST, manifest)]:
        part = target / f".{name}.part"
        part.write_bytes(body)
        os.replace(part, target / name)
    return {n: len(b) for n, b in (bodies | {MANIFEST: manifest}).items()}


# ---------------------------------------------------------------- exploration


def entity_kinds(lines: DataFrame, kinds: tuple[str, ...] = ("vehicle", "trip_update", "alert")) -> DataFrame:
    """How many entities of each kind a landed snapshot holds."""
    has = lambda k: F.get_json_object(F.to_json("entity"), f"$.{k}").isNotNull()
    kind = F.coalesce(*[F.when(has(k), k) for k in kinds], F.lit("other"))
    return lines.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def overlap(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys two snapshots share, and how many only one has."""
    marked = a.select(*keys).distinct().withColumn("_in", F.lit(1)).unionByName(b.select(*keys).distinct().withColumn("_in", F.lit(2)))
    sides = marked.groupBy(*keys).agg(F.sum("_in").alias("_in"))
    return sides.agg(*[F.count_if(F.col("_in") == n).alias(name) for n, name in ((3, "in_both"), (1, "only_first"), (2, "only_second"))])

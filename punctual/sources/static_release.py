"""Static schedule releases: zip files of CSV texts, kept as text by version, and the typed stop times."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions import scalars as S

_VERSION = re.compile(r"[\w.-]+")


def version_of(archive: Path) -> str:
    """The version stated in feed_info.txt (a byte order mark is skipped); an error if there is none."""
    with zipfile.ZipFile(archive) as z:
        name = next((n for n in z.namelist() if PurePosixPath(n).name == "feed_info.txt"), None)
        row = next(csv.DictReader(io.StringIO(z.read(name).decode("utf-8-sig"))), None) if name else None
    version = ((row or {}).get("feed_version") or "").strip()
    if not version:
        raise ValueError(f"{archive}: no feed_version")
    return version


def extract(archive: Path, folder: Path) -> list[Path]:
    """The archive's text files, by base name alone, so none can land outside ``folder``."""
    folder.mkdir(parents=True, exist_ok=True)
    out = []
    with zipfile.ZipFile(archive) as z:
        for info in z.infolist():
            name = PurePosixPath(info.filename.replace("\\", "/")).name
            if name.endswith(".txt") and not info.is_dir():
                target = folder / name
                target.write_bytes(z.read(info))
                out.append(target)
    return sorted(out)


def load(lake, archive: Path, folder: Path) -> dict[str, int]:
    """Each text file of a release into its table, in place of that version's earlier rows; rows by table."""
    version = version_of(archive)
    done = {}
    for path in extract(archive, folder / version):
        # Unpacked here, read everywhere: tasks get the texts from the lake's own storage.
        text = lake.put(path, f"_releases/{version}/{path.name}")
        rows = lake.spark.read.option("header", True).option("inferSchema", False).csv(text).drop("feed_version").select(
            "*", F.lit(version).alias("feed_version"), F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_loaded_at")
        )
        table = f"static_{path.stem}"
        lake.replace_range(table, rows, "feed_version", version, version, ["feed_version"])
        done[table] = lake.read(table).where(F.col("feed_version") == version).count()
    return done


STOP_TIME_NUMBERS = {"stop_sequence": "int", "timepoint": "int", "shape_dist_traveled": "double"}


def stop_times(raw: DataFrame) -> DataFrame:
    """Stop times with schedule times in seconds and numbers as such; columns a release lacks are null."""
    number = lambda c, k: (F.col(c).try_cast(k) if c in raw.columns else F.lit(None).cast(k)).alias(c)
    return raw.select(
        "feed_version", "trip_id", "stop_id", number("stop_sequence", "int"), S.clock_seconds(F.col("arrival_time")).alias("arrival_secs"),
        S.clock_seconds(F.col("departure_time")).alias("departure_secs"), number("timepoint", "int"), number("shape_dist_traveled", "double"),
    )


def build_stop_times(lake, version: str) -> int:
    """Types one release's stop times, in place of that version's earlier ones; returns how many."""
    if not _VERSION.fullmatch(version):
        raise ValueError(f"not a release name: {version!r}")
    here = F.col("feed_version") == version
    lake.replace_range("silver_stop_times", stop_times(lake.read("static_stop_times").where(here)), "feed_version", version, version, ["feed_version"])
    return lake.read("silver_stop_times").where(here).count()

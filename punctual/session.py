"""Session defaults, table loading and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_ZONE = "America/New_York"


def build_session(app: str = "punctual", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, AQE and Arrow; ``conf`` overrides any setting (dots as ``__``)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamp columns as UTC instants (the session zone must be UTC)."""
    ntz = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Table ``name`` of a directory with one Parquet file or folder per table."""
    return utc_timestamps(spark.read.parquet(f"{directory}/{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir`` of the session.

    Only on a single machine (``local[...]``, as in tests) a folder is made where it is unset; on a cluster that is an
    error, as a folder of the driver's disk is of no use to executors.
    """
    sc = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not place:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors can read")
        place = "file://" + tempfile.mkdtemp(prefix="punctual-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(place)
    return place


_MADE: list[tuple] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, which ``release`` removes, as does the end of the program."""
    where = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    if not _MADE:
        atexit.register(release)
    _MADE.append((spark, path.getFileSystem(spark._jsc.hadoopConfiguration()), path))
    return where


def release(spark: SparkSession | None = None) -> int:
    """Removes what was written to paths of ``shared_path`` (of one session), once its results are used; returns how many."""
    done = 0
    for made in list(_MADE):
        owner, fs, path = made
        if spark is not None and owner is not spark:
            continue
        _MADE.remove(made)
        try:
            done += fs.delete(path, True)
        except Exception:  # the JVM is gone, and the folder is its owner's to clear
            continue
    return done


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder; survives a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many parts as the cluster has cores, for stages that compute much per row.

    Tables of any size that matters have more parts and stay as they are; only a few files are dealt out anew.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df

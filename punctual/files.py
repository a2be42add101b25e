"""Files that tasks read and write themselves, on the file system that Spark would use for the same address."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

#: Schemes that Hadoop and pyarrow call differently.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def qualified(spark: SparkSession, where: str) -> str:
    """``where`` with scheme and host: without a scheme it lies on Spark's default file system, not on a task's disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified address and the path on it; a bare path is taken for a local one."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def write_whole(fs: pafs.FileSystem, path: str, body: bytes) -> None:
    """Whole or not at all."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        out.write(body)
    fs.move(part, path)

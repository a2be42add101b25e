"""Landed files on the storage that Spark uses."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession


class HadoopStore:
    """A store for ``Mirror`` on any of Hadoop's file systems; a file appears whole, under a hidden name first."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def upload(self, path: str, content: Any, overwrite: bool = True) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        target = hadoop.Path(path)
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        part = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}.part")
        out = fs.create(part, True)
        try:
            while piece := content.read(1 << 20):
                out.write(bytearray(piece))
        finally:
            out.close()
        if overwrite:
            fs.delete(target, False)
        if not fs.rename(part, target):
            fs.delete(part, False)
            raise FileExistsError(path)

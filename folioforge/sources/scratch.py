"""Scratch paths in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; a temporary folder only where that is unset on a local master."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("folioforge.shared.dir", None)
    if not place:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        place = tempfile.mkdtemp(prefix="folioforge-")
        spark.conf.set("folioforge.shared.dir", place)
    return f"{place.rstrip('/')}/folioforge/{what}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark resolves it to, so that other libraries mean the same place."""
    fs, p = file_system(spark, path)
    return fs.makeQualified(p).toString()

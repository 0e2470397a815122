"""The session, and where a job may put its own files."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC and adaptive execution; on a cluster the master is left to the submitter."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder's path below spark.checkpoint.dir, which driver and executors share.

    Where that is unset a temporary folder serves, on one machine only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("ledgerloom.scratch.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("ledgerloom.scratch.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, where it is not installed there."""
    home = os.path.dirname(os.path.abspath(__file__))
    packed = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="spark-"), "ledgerloom"), "zip", os.path.dirname(home), os.path.basename(home))
    spark.sparkContext.addPyFile(packed)

"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a local session (one process, as in tests) takes a folder that goes with it.

    A cluster has to set it: other machines wouldn't see a folder of the driver's.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="cdclake-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return f"file://{_own_dir[0]}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/cdclake/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as written to the shared folder: worked out once, whatever reads it."""
    path = new_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "gridtally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on.

    Charge periods are rendered as UTC instants, so the session time zone is
    fixed. The JVM never compiles a method of more than 8,000 bytes of code; with
    the limit set to that, Spark splits a larger stage into small methods instead
    of having it interpreted. Shuffle partition counts are left to adaptive
    execution.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="gridtally-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A fresh path for intermediate tables, removed when the session's JVM ends.

    It lies in ``base``, or else in the shared folder named by
    ``spark.checkpoint.dir``. With neither, a folder is only made up for a master
    that runs in one process; any other master would spread the files over
    machine-local disks, so that raises.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        base = f"file://{_own_folder()}"
    path = f"{base.rstrip('/')}/gridtally/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def written_once(df: DataFrame, label: str) -> DataFrame:
    """The rows of a frame, worked out once and read back from the shared folder.

    For an aggregate that a plan reads several times: Catalyst prunes each use
    to other columns, so their shuffles are not shared and the facts below would
    be scanned again. A written table also survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

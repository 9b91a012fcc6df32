"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallyfield", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; ``conf`` adds or overrides settings."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master, where driver and
    executors are one process; on a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(context.applicationId)


@lru_cache(maxsize=1)
def _local_folder(application: str) -> str:
    """One temporary folder per local application."""
    return tempfile.mkdtemp(prefix=f"tallyfield-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later steps read stored rows, so a lost executor costs a re-read and never
    a second, possibly different, evaluation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
#: Fixed value: the setting by which Spark removes an execution's shuffle files at its end, not when the driver collects its garbage.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "jobtide", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library is tuned for; *conf* overrides use ``__`` for dots.

    Shuffle partitions start high and adaptive execution coalesces them, so one setting serves small and
    large inputs; on a cluster set ``spark.sql.shuffle.partitions`` to 2-3 times the total cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executions inside remove their shuffle files when they end; for runs of writes that read each other's files only."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or in local mode one of this process, removed at its end."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="jobtide-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"

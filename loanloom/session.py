"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app: str = "loanloom", master: str | None = None, shuffle_partitions: int | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with UTC dates and adaptive execution, and any further ``settings``.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset, so that spark-submit decides and AQE
    coalesces; ``spark.sql.shuffle.partitions`` is then the upper bound of parallelism after a shuffle.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # The one JVM is driver and executors at once; Spark's default of 1 GB is too little for that.
            builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.config(map=settings or {}).getOrCreate()


#: The JVM compiles no method above 8000 bytes of code; Spark's own limit for a fused stage is eight times that.
COMPILED_BYTES = 8000


def compiled(spark: SparkSession) -> None:
    """Stages whose one fused method would run uncompiled are run as several smaller methods instead. Results stay the same."""
    setting = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(setting)) > COMPILED_BYTES:
        spark.conf.set(setting, str(COMPILED_BYTES))


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder path below the cluster's shared folder (``spark.checkpoint.dir``).

    A local session without that setting gets a temporary folder; a cluster session without it is an
    error, since a machine-local folder would not be seen by the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "loanloom")
    return f"{base.rstrip('/')}/loanloom/{label}-{uuid.uuid4().hex}"

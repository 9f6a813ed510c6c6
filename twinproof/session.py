"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(
    app: str = "twinproof", master: str | None = None, shuffle_partitions: int | None = None, memory: str | None = None
) -> SparkSession:
    """A session with the settings the jobs here are planned for.

    AQE picks broadcast joins from measured sizes, splits skewed join partitions and merges small
    shuffle partitions, so nothing below hints a join strategy on data that can grow.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory:  # heap of the one process in local mode
        builder = builder.config("spark.driver.memory", memory)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediate tables, below ``spark.checkpoint.dir``.

    Executors of a cluster share that folder. Only a local-mode session may go without the setting;
    it then gets a temporary folder, because driver and executors are one process there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="twinproof-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"

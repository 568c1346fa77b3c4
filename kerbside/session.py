"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings, safe to apply to a session that already exists.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task of the partitioned trip write sees one monthly file, or a few. Keeping a writer open
    # for each saves sorting every row by its partition columns first.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    app: str = "kerbside", cores: int | str = "*", memory: str = "8g", partitions: int = 8
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def job_session(spark: SparkSession) -> SparkSession:
    """A session of the job's own with :data:`RUNTIME_CONF`; the caller's settings stay untouched.

    Batch expressions do not depend on the zone. It matters where zoned times come in: files that
    store them, and streams, whose event time has to be zoned; wall-clock times survive that cast
    unchanged only under UTC.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return configure(own)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting only a local master gets a folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="kerbside-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

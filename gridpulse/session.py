"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Calendar dates are UTC dates, so the session must compute in UTC.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every entry point needs."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(
    app_name: str = "gridpulse", master: str | None = None, **conf: object
) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return prepare_session(builder.getOrCreate())


def shared_scratch(spark: SparkSession) -> str:
    """The folder every executor can reach, where intermediate results lie.

    It is what ``spark.checkpoint.dir`` names; there is no other choice, since a
    folder of one machine would be lost to the others.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        raise RuntimeError(f"Set {CHECKPOINT_DIR} to a folder shared by all executors")
    return configured.rstrip("/")

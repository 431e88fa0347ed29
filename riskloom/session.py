"""SparkSession construction and the few session settings the jobs rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job assumes.  Time zone pinned to UTC so DATE()/datediff agree with the
# UTC instants of the event log; AQE on for runtime coalescing and skew-join splitting.
_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    app_name: str = "riskloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for the jobs (local master only when asked for)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in _REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read.  When it is
    unset (local tests) a fallback is configured so ``DataFrame.checkpoint()`` works.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = current.get() if current.isDefined() else None
    if not current:
        if not fallback and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        current = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "riskloom-checkpoints")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(current)
    return current


def materialize(df):
    """Reliable checkpoint (shared ``spark.checkpoint.dir``) that computes ``df`` once.

    A bare ``checkpoint()`` runs the plan twice (once for the action, once for the writer);
    caching for the duration of the write avoids that.  The result reads from the written
    files, so its lineage no longer reaches back to the inputs and a lost executor costs a
    re-read, not a recompute.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out

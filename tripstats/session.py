"""Spark session helpers and the shared scratch location.

Everything heavy runs inside Spark; this module only builds a session with the
settings the library relies on and hands out fresh paths under the shared
checkpoint folder (``spark.checkpoint.dir``), which on a cluster must be a
shared file system.  A machine-local temporary folder is only created when the
session has no checkpoint folder and its master is local (tests, a laptop); a
cluster session without one is refused.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the plans are written against.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting covers a hot
# join key; UTC keeps text timestamps and hour/weekday extraction stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tripstats",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with :data:`BASE_CONF` applied.

    Under ``spark-submit`` the submitted master and shuffle-partition count
    are kept (size ``spark.sql.shuffle.partitions`` to the data, about
    128-256 MB of shuffle data per partition; AQE coalesces from there).
    In a plain Python process the session is local: ``master`` defaults to
    ``local[N]`` and the shuffle partitions to ``N``, where ``N`` is
    ``$BENCH_CPUS`` or the machine's core count.
    """
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ  # launched by spark-submit
    builder = SparkSession.builder.appName(app_name)
    if master is None and not submitted:
        master = f"local[{cpus}]"
    if master is not None:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None or not submitted:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    if not submitted:
        conf.setdefault("spark.driver.memory", "8g")
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session first (``spark.checkpoint.dir`` or the context's
    checkpoint directory).  When neither is set, a session with a local master
    gets a fresh local folder, registered as the checkpoint folder; any other
    session is refused, since its executors could not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if re.fullmatch(r"local(\[[^\]]*\])?", master) is None:
            raise RuntimeError(
                f"spark.checkpoint.dir is not set (master {master!r}); "
                "name a folder there that the driver and all executors share"
            )
        root = tempfile.mkdtemp(prefix="tripstats-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used path under the shared checkpoint folder.

    Every write gets its own path, so no plan ever overwrites a directory it
    is still reading from, and a retried job never sees a half-written table.
    """
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; below 0 when broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text)
    if m is None:
        raise ValueError(f"spark.sql.autoBroadcastJoinThreshold: {text!r}")
    return int(m[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[m[2]]

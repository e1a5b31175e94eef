"""Session construction and shared storage locations."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. UTC matters: the raw timestamps carry a
# literal 'Z' that Spark's pattern treats as text, so they are read in the
# session zone.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "hostelry", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults; for tests and bench."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage and we only read it.
    Only when it is unset (local tests) do we create a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: only the SQL conf is visible
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share") from None
        return path
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="hostelry-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A location below the shared checkpoint folder for tables a job writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])

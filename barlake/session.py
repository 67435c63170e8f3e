"""Session settings and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the plans below profit from.  Applied only where the session does not
# say otherwise, so a cluster's own defaults win.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot instrument's side of a join even where that costs the operators above
    # their ready-made partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on (ts_code, trade_date) may reuse rows already shuffled by ts_code, so a
    # chain of window -> join -> window costs one exchange on the bar side.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(app: str = "barlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SQL_DEFAULTS, "spark.sql.session.timeZone": "UTC", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL defaults to a session somebody else built, unless it set them itself."""
    chosen = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in _SQL_DEFAULTS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder named by the session.

    Only a local session without that setting gets a folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="barlake-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/barlake/{name}-{uuid.uuid4().hex}"

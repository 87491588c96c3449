"""SparkSession construction.

Settings are only applied when the caller (or the cluster) has not set
them already, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter for correctness (UTC) or for runtime re-planning at
# scale (AQE partition coalescing and skew splits).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Of a session of its own on this machine (tests, bench): no Derby metastore, no web page.
LOCAL = {
    "spark.sql.catalogImplementation": "in-memory",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "tapehouse",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session; ``DEFAULTS`` apply only where nothing is set.

    What the cluster or the submit command sets wins over them, ``conf`` over both.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = LOCAL if (master or "").startswith("local") else {}
    for key, value in (local | (conf or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in (conf or {}) and not given.contains(key):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory of the session.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``,
    and an error if there is none: executors do not see each other's disks.
    Only a local session, as in tests, gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tapehouse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint directory for staged writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"

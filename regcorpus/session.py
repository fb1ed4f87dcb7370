"""Session construction and cluster-aware settings.

Nothing here forces a master: on a cluster the submitter decides.  The local
defaults are only applied when a session has to be created from scratch
(tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this repo relies on.  AQE re-plans joins and coalesces
# small shuffle partitions at run time; skew-join splitting covers hot keys.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # bounded Arrow batches for the HTML walk (documents can be large)
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "regcorpus",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session with the repo's core settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the operator (a shared file
    system) and is only read here; without it a cluster session fails.  With a
    local master — tests — a scratch folder is made once and remembered under ``regcorpus.scratch.dir``
    (``spark.checkpoint.dir`` itself cannot be changed at run time)."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("regcorpus.scratch.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="regcorpus-ckpt-")
        spark.conf.set("regcorpus.scratch.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)

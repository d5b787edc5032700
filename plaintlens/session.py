"""Session settings the operators are designed for. Any session works; these are the recommended ones."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split hot join keys even where that costs one more exchange downstream
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # skip recording a Python call site for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


RUNTIME = [
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.forceOptimizeSkewedJoin",
]


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that may change at run time to a session someone else created.

    Only where they are not what is wanted already: sessions from `build_session` are left as they are.
    """
    for key in RUNTIME:
        if spark.conf.get(key) != SETTINGS[key]:
            spark.conf.set(key, SETTINGS[key])
    return spark


def build_session(app: str = "plaintlens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session's spark.checkpoint.dir names it.

    Where none is named, one process on one machine gets a temporary folder; a cluster gets an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="plaintlens-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")

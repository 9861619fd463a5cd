"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Instants are parsed and written in UTC whatever zone the cluster runs in.
SETTINGS = {"spark.sql.session.timeZone": "UTC"}


def build_session(app: str = "tallystream", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **SETTINGS,
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """The same settings on a session somebody else built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode with none configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tallystream-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; later stages no longer depend on its executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()

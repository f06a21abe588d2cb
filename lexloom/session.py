"""Session defaults and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "lexloom", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the session is given by the caller."""
    b = SparkSession.builder.appName(app)
    if cpus:
        b = b.master(f"local[{cpus}]").config("spark.driver.memory", os.environ.get("LEXLOOM_DRIVER_MEMORY", "8g"))
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared checkpoint folder, so that a lost executor loses nothing.

    The folder is the session's spark.checkpoint.dir; a folder of our own is set only where that is unset and the
    master is local, as in tests."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="lexloom-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()

"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

#: Settings the operators are written for. A cluster's own defaults may override any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Documents differ in length by four orders of magnitude, so batches to Python are cut by bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}


def build_session(app: str = "tierloom", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session with :data:`SETTINGS`; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Nothing is created here. Only a local-mode session without the setting falls back to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="tierloom-")
    return f"{base.rstrip('/')}/tierloom/{purpose}-{uuid.uuid4().hex}"


def carry_to_workers(module: str) -> None:
    """Send the functions of a module along with each task that uses them; workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])

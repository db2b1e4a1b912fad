"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

#: Settings worth giving to a cluster submit. They split hot join and rebalance
#: partitions and keep every wall-clock value free of a zone.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the call site of every column costs most of the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, app_name: str = "ledgerlens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path under the shared folder named by ``spark.checkpoint.dir``.

    A local temporary folder is used only where that setting is absent and the
    session is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="ledgerlens-")

"""Session defaults and the shared scratch folder."""

import uuid

from pyspark.sql import SparkSession

# Adaptive execution carries the skew handling: plain scans meet in sort-merge joins whose
# oversized partitions are split at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_session(app_name: str = "storelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or else below the warehouse folder.

    Both are shared by the driver and all executors; a machine's own temporary folder is never used. On a cluster a
    warehouse folder of the driver's own file system, Spark's default, is refused.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {root} is the driver's own")
    return f"{root.rstrip('/')}/storelake/{app}/{label}-{uuid.uuid4().hex}"

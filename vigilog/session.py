"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime-settable options; safe to apply to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # row_number() <= k is cut map-side only for k below this value; the
    # sampler asks for three times its budget.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the options every operator relies on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "vigilog", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``master`` stays unset under spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the cluster.

    A local session without ``spark.checkpoint.dir`` (a test) gets a temporary
    one; on a cluster, where executors could not see it, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="vigilog-")
    return f"{root.rstrip('/')}/vigilog/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage like a checkpoint, but as columnar files: a later pass
    reads only the columns it needs and lost executors cost nothing.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Shared scratch space: landed files, sink output, stream and RDD checkpoints.

Everything goes below ``spark.checkpoint.dir``, the folder every executor can
reach. Only a session on one machine without that setting (a test) gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        shared = context.getCheckpointDir()
    return shared.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to; the first writer creates it."""
    return f"{root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint that survives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root(df.sparkSession))
    return df.checkpoint(eager=True)


def laid_out(df: DataFrame, *keys: str) -> DataFrame:
    """Checkpoint ``df`` hash-partitioned and sorted by ``keys``, in a form later joins on ``keys``
    recognise: they neither exchange nor sort it again.

    Adaptive execution may merge partitions and then no longer vouches for them, so it
    is off for this one write; ``df`` should be a plain scan or an earlier checkpoint.
    """
    conf, adaptive = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(adaptive)
    conf.set(adaptive, "false")
    try:
        return cut(df.repartition(*keys).sortWithinPartitions(*keys))
    finally:
        conf.set(adaptive, before)

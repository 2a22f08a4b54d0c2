"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime settings that results or plans depend on. All of them may be set on a
#: live session, so ``tune`` works on a session the caller already owns.
RUNTIME = {
    # time buckets are defined in UTC
    "spark.sql.session.timeZone": "UTC",
    # let AQE split a skewed join even where that costs one more exchange
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # state larger than the executor heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # commit a batch's changes rather than a snapshot of the whole state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # merge the sessions of one key inside each input partition before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME`` except where the cluster configured a key itself."""
    cluster = spark.sparkContext.getConf()
    for key, value in RUNTIME.items():
        if not cluster.contains(key) and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

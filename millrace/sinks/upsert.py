"""Keyed upsert, last write wins, as a log of batches.

A batch costs what it writes: it stores its own rows under ``batch_id=<n>`` and
never rewrites the table. Readers resolve a key to its newest row with a
combinable ``max_by``; ``compact`` folds the log into a new one.

With ``fold_every`` the stream compacts as it goes: after every so many batches the state is written as a fold beside the log, and readers
begin at the newest fold that is complete. Batches and earlier folds stay, so a reader that began before still has its files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks.files import batch_dir


@dataclass(frozen=True)
class UpsertLog:
    path: str
    keys: tuple[str, ...]
    fold_every: int = 0

    def create_if_missing(self, spark: SparkSession, schema: T.StructType) -> None:
        """Make an empty table readable before the first batch; a no-op once it has rows."""
        spark.createDataFrame([], schema).write.mode("ignore").parquet(batch_dir(self.path, -1))

    def write(self, df: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Store a batch; several rows of one key are reduced to the one with the greatest ``order``."""
        rows = newest(df, self.keys, order) if order else df
        rows.write.mode("overwrite").parquet(batch_dir(self.path, batch_id))
        if self.fold_every and (batch_id + 1) % self.fold_every == 0:
            # what came before is complete, so a batch that runs again writes the same fold
            self.read(df.sparkSession, upto=batch_id).write.mode("overwrite").parquet(f"{self._folds}/{batch_id:012d}")

    @property
    def _folds(self) -> str:
        return f"{self.path}/_folds"  # names with an underscore are no part of the table

    def _numbers(self, spark: SparkSession, path: str, prefix: str, complete: bool) -> list[int]:
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        found = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith(prefix)]
        done = [p.getName() for p in found if not complete or files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(name.removeprefix(prefix)) for name in done)

    def folds(self, spark: SparkSession) -> list[int]:
        """The batches whose fold is complete, in order."""
        return self._numbers(spark, self._folds, "", complete=True)

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The newest row of every key; with ``upto``, as of that batch. Reads the newest fold before it and the batches since."""
        if not self.fold_every and upto is None:
            return newest(spark.read.parquet(self.path), self.keys, ["batch_id"]).drop("batch_id")
        folds = [n for n in self.folds(spark) if upto is None or n < upto]
        since = [n for n in self._numbers(spark, self.path, "batch_id=", complete=False) if n > (folds[-1] if folds else -2) and (upto is None or n <= upto)]
        parts = []
        if since:
            parts.append(spark.read.option("basePath", self.path).parquet(*[batch_dir(self.path, n) for n in since]))
        if folds:
            parts.append(spark.read.parquet(f"{self._folds}/{folds[-1]:012d}").withColumn("batch_id", F.lit(folds[-1])))
        log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        return newest(log, self.keys, ["batch_id"]).drop("batch_id")

    def compact(self, spark: SparkSession, path: str) -> UpsertLog:
        """Write the current state as the first batch of a new log."""
        folded = UpsertLog(path, self.keys)
        self.read(spark).write.mode("overwrite").parquet(batch_dir(path, 0))
        return folded


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; a null comes before all values, ties are settled by the whole row."""
    rest = [c for c in df.columns if c not in keys]
    # a struct is never null, so a key whose rows have no order still keeps one of them
    best = F.max_by(F.struct(*rest), F.struct(*order, F.to_json(F.struct(*rest))))
    return df.groupBy(*keys).agg(best.alias("r")).select(*keys, "r.*").select(*df.columns)

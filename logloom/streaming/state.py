"""Per-stream state carried between micro-batches as tables in the shared folder.

Every epoch writes the rows it changed; every ``SNAPSHOT_EVERY`` epochs also the whole
state. An epoch reads the last snapshot before it and the changes since, so its input
is fixed by its number and a replayed epoch sees and writes the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_EVERY = 16


class StateTable:
    """State rows ``(stream_id, <order column>, ...)``; the largest order value wins."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, order: str):
        self.spark, self.path, self.schema, self.order = spark, path, schema, order

    def before(self, epoch: int) -> DataFrame:
        """The state left by all epochs before ``epoch``."""
        last_snapshot = epoch // SNAPSHOT_EVERY * SNAPSHOT_EVERY - 1
        paths = [f"{self.path}/changes/epoch={e}" for e in range(last_snapshot + 1, epoch)]
        if last_snapshot >= 0:
            paths.insert(0, f"{self.path}/snapshots/epoch={last_snapshot}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self._latest(self.spark.read.schema(self.schema).parquet(*paths))

    def write(self, epoch: int, changed: DataFrame) -> None:
        changed.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/changes/epoch={epoch}")
        if (epoch + 1) % SNAPSHOT_EVERY == 0:
            stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/changes/epoch={epoch}")
            whole = self._latest(self.before(epoch).unionByName(stored))
            whole.write.mode("overwrite").parquet(f"{self.path}/snapshots/epoch={epoch}")

    def _latest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in self.schema.names if c not in ("stream_id", self.order)]
        return rows.groupBy("stream_id").agg(
            F.max(self.order).alias(self.order), *[F.max_by(c, self.order).alias(c) for c in values]
        )

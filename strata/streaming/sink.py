"""A stream that goes straight into versioned state, every epoch once.

Each micro-batch is staged under its epoch number, applied to the state, and
then recorded. Staging overwrites its own epoch and applying drops what the batches
had in the state before, so an epoch that is run again after a stop anywhere
gives the same state, and one that was recorded is passed over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import scd
from strata.operators.publish import Progress
from strata.session import has_data

EPOCH = "_epoch"


class StateSink:
    """Applies a stream of rows with a batch key to a ``Scd1State`` / ``Scd2State``.

    Rows of one batch may come in several epochs, late and out of order; ``stage``
    makes all rows that a batch has so far into its staged rows (one per key and
    batch). The state is taken forward from the earliest batch that the epoch
    has rows of. ``on_apply`` is told the epoch before its record is
    written; if it raises, the epoch is run again by the next start.
    """

    def __init__(self, spark: SparkSession, root: str, state: scd._State, stage: Callable[[DataFrame], DataFrame],
                 batch_col: str = scd.BATCH, fold_every: int | None = None, on_apply: Callable[[int], None] | None = None):
        self.spark, self.root, self.state, self.stage = spark, root.rstrip("/"), state, stage
        self.batch_col, self.fold_every, self.on_apply = batch_col, fold_every, on_apply
        self.progress = Progress(spark, f"{self.root}/_progress")

    def _rows(self, schema: T.StructType, upto: int) -> DataFrame:
        """The raw rows of the epochs so far; one that was only begun isn't among them."""
        if not has_data(self.spark, f"{self.root}/epochs"):
            return self.spark.createDataFrame([], schema)
        known = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])
        rows = self.spark.read.schema(known).parquet(f"{self.root}/epochs").filter(F.col(EPOCH) <= upto)
        return rows.select(*[f"`{c}`" for c in schema.names])

    def apply(self, batch: DataFrame, epoch: int) -> bool:
        """One micro-batch; False if it had been applied and recorded."""
        done = self.progress.read().get("epoch", -1)
        if epoch <= done:
            return False
        batch.write.mode("overwrite").partitionBy(self.batch_col).parquet(f"{self.root}/epochs/{EPOCH}={epoch}")
        rows = self._rows(batch.schema, epoch)
        mine = self.spark.read.schema(batch.schema).parquet(f"{self.root}/epochs/{EPOCH}={epoch}").select(F.col(self.batch_col).cast("string").alias("b"))
        first = mine.agg(F.min("b")).first()[0]
        if first is not None:
            # batches before the first one touched stay as they are and aren't read
            due = rows.filter(F.col(self.batch_col).cast("string") >= first)
            before = [b for b in self.state.applied() if b < first]
            self.state.drop_from(first)
            staged = self.stage(due).withColumn(self.batch_col, F.col(self.batch_col).cast("string")).withColumnRenamed(self.batch_col, scd.BATCH)
            batches = sorted(r[0] for r in staged.select(scd.BATCH).distinct().collect())
            if batches:
                self.state.apply_all(staged, batches, before[-1] if before else None)
                self.state.fold(self.fold_every)
        if self.on_apply is not None:
            self.on_apply(epoch)
        self.progress.write({"epoch": epoch})
        return True

    def drain(self, stream: DataFrame, checkpoint: str) -> None:
        """Applies all that the stream has now."""
        (stream.writeStream.foreachBatch(lambda batch, epoch: self.apply(batch, epoch)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

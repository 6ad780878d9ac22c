"""Realized weeks arrive as files; each micro-batch goes through the adaptive loop once.

The job is meant to be started on a schedule: every start handles what has arrived since the last one
and stops. The checkpoint remembers what was read. A micro-batch that is repeated after a failure
carries the same batch number, and the log and the profiles of that number are replaced, not appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans.adaptive import AdaptiveLoop, LoopResult


class FeedbackStream:
    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        schema: StructType | str,
        loop: AdaptiveLoop,
        checkpoint: str,
        actual: str = "num_orders",
        files_per_batch: int | None = None,
    ) -> None:
        self.spark, self.landing, self.schema = spark, landing, schema
        self.loop, self.checkpoint, self.actual = loop, checkpoint, actual
        self.files_per_batch = files_per_batch
        self.results: dict[int, LoopResult] = {}

    def _handle(self, batch: DataFrame, number: int) -> None:
        self.results[number] = self.loop.process(batch, self.actual, batch_id=number)

    def run_available(self) -> None:
        """Process everything that has arrived and return."""
        reader = self.spark.readStream.schema(self.schema)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        query = (
            reader.parquet(self.landing)
            .writeStream.foreachBatch(self._handle)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

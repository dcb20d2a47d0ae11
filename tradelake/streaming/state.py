"""A small table kept from micro-batch to micro-batch."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tradelake.sources.files import Files


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns a checkpoint; it outlives restarts."""
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
    return json.loads(text)["id"]


@dataclass(frozen=True)
class BatchState:
    """States in folders ``number_query_batch``; numbers rise whatever query writes.

    A batch that is run again starts from the state before it and replaces its own. A
    query with a new checkpoint goes on from the last state.
    """

    spark: SparkSession
    path: str

    def _names(self) -> list[str]:
        files = Files(self.spark, self.path)
        names = files.children(self.path)
        return sorted(n for n in names if files.exists(f"{self.path}/{n}/_SUCCESS"))

    def _read(self, name: str | None, schema: str) -> DataFrame:
        if name is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def read(self, schema: str) -> DataFrame:
        """The last state; empty before the first batch."""
        return self._read(next(reversed(self._names()), None), schema)

    def fold(
        self, query: str, batch_id: int, schema: str, step: Callable[[DataFrame], DataFrame]
    ) -> None:
        """Store ``step`` of the state before this batch as the state after it."""
        names = self._names()
        own = [int(n.split("_")[2]) for n in names if n.split("_")[1] == query]
        again = bool(names) and names[-1].split("_")[1:] == [query, str(batch_id)]
        if not again and batch_id > 0 and max(own, default=-1) != batch_id - 1:
            raise RuntimeError(f"the state before batch {batch_id} is missing in {self.path}")
        earlier = names[:-1] if again else names
        number = int(earlier[-1].split("_")[0]) + 1 if earlier else 0
        after = step(self._read(earlier[-1] if earlier else None, schema))
        name = f"{number:012d}_{query}_{batch_id}"
        after.write.mode("overwrite").parquet(f"{self.path}/{name}")
        for old in earlier[:-1]:
            Files(self.spark, self.path).delete(f"{self.path}/{old}")


def each_batch(
    stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, str, int], None]
) -> StreamingQuery:
    """Run ``work`` with every micro-batch that is there, the query's id and its number."""

    def run(batch: DataFrame, batch_id: int) -> None:
        work(batch, query_id(batch.sparkSession, checkpoint), batch_id)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

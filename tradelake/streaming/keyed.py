"""A few numbers per key in Spark's RocksDB state store.

A stream whose micro-batches are cut into chunks, so that a key with most of the rows is
not walked in one task, cannot keep its state inside its own plan: it asks a state query
for the keys of a batch, works, and tells the state query what became of them. That query
takes messages from a folder, ``transformWithState`` merges them, and its checkpoint holds
the store. What a batch writes follows the keys in it, not the keys there are.

Messages are merged by taking the later state, which may be repeated and reordered, so a
batch that is run again changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tradelake.session import ROCKSDB, written
from tradelake.sources.files import Files

STATE = "open bigint, last bigint, seen map<string, bigint>"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # A commit uploads the changes of its batch; snapshots are made in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Silent keys are forgotten with the next question, not in a batch of their own.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class Latest(StatefulProcessor):
    """The latest ``open`` of a key with the counts that belong to it, and its ``last`` time.

    A key is forgotten when event time has passed ``last`` by ``idle_ms``.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "open bigint, last bigint")
        self.seen = handle.getMapState("seen", "kind string", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.held.get() if self.held.exists() else None
        open_, last = held if held is not None else (None, None)
        before, asked, counts = (open_, last), [], {}
        for row in rows:
            if row["asked"] is not None:
                asked.append(row["asked"])
            if row["open"] is None:
                continue
            last = row["last"] if last is None else max(last, row["last"])
            if open_ is None or row["open"] > open_:
                open_, counts = row["open"], {}
                self.seen.clear()
            if row["open"] == open_:
                for kind, n in dict(row["seen"] or ()).items():
                    counts[kind] = max(n, counts.get(kind, 0))
        for kind, n in counts.items():
            known = self.seen.getValue((kind,)) if self.seen.containsKey((kind,)) else (0,)
            if n > known[0]:
                self.seen.updateValue((kind,), (n,))
        if (open_, last) != before:
            self.held.update((open_, last))
            if before[1] is not None:
                self.handle.deleteTimer(self._idle(before[1]))
            self.handle.registerTimer(self._idle(last))
        if asked and open_ is not None:
            seen = {kind[0]: n[0] for kind, n in self.seen.iterator()}
            for question in asked:
                yield Row(key=key[0], open=open_, last=last, seen=seen, asked=question)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _idle(self, last: int) -> int:
        return max(last + self.idle_ms, 0)


class KeyedState:
    """The state of one stream's keys, below ``path``; one stream asks at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str, idle_ms: int):
        self.spark, self.path, self.key, self.kind, self.idle_ms = spark, path, key, kind, idle_ms
        self.inbox, self.checkpoint = f"{path}/inbox", f"{path}/store"
        self.files = Files(spark, path)
        self.message = f"key {kind}, {STATE}, asked string, clock timestamp"

    def is_done(self, query: str, batch_id: int) -> bool:
        """Whether this batch has told what became of its keys."""
        return self.files.exists(f"{self._told(query, batch_id)}/_SUCCESS")

    def ask(self, rows: DataFrame, query: str, batch_id: int) -> DataFrame:
        """``key``, ``open``, ``last`` and ``seen`` of the keys of ``rows`` (``at_ms``)
        that are known."""
        # What an interrupted run of this batch has told in part must not count.
        self.files.delete(self._told(query, batch_id))
        question = uuid.uuid4().hex
        keys = rows.select(F.col(self.key).alias("key")).distinct()
        newest = rows.agg(F.max("at_ms")).first()[0]
        # Spark's watermark starts at 0, and what is not after it counts as late.
        clock = max(self._clock(), 1 if newest is None else newest, 1)
        self._put(keys.withColumn("asked", F.lit(question)), f"{self.inbox}/ask-{clock:020d}-{question}", clock)
        answers = f"{self.path}/answers/{question}"
        self._merge(answers)
        found = [f"{answers}/{n}" for n in self.files.children(answers)]
        schema = f"key {self.kind}, {STATE}, asked string"
        known = self.spark.createDataFrame([], schema)
        if found:
            known = self.spark.read.schema(schema).parquet(*found).filter(F.col("asked") == question)
        known = written(known.select(F.col("key").alias(self.key), "open", "last", "seen"), "states")
        self._tidy(answers, query, batch_id)
        return known

    def tell(self, states: DataFrame, query: str, batch_id: int) -> None:
        """Keep these states (``key``, ``open``, ``last``, ``seen``); later ones win."""
        named = states.select(F.col(self.key).alias("key"), "open", "last", "seen")
        self._put(named, self._told(query, batch_id), self._clock())

    def read(self) -> DataFrame:
        """All keys that are known, as of the last question."""
        found = self.spark.read.format("statestore").option("stateVarName", "held").load(self.checkpoint)
        return found.select(F.col("key.key").alias(self.key), "value.open", "value.last")

    def _tidy(self, answers: str, query: str, batch_id: int) -> None:
        """Drop what has been merged: all questions but the latest, and what earlier
        batches told, but for the one that tells a repeated batch that it is done."""
        names = sorted(self.files.children(self.inbox))
        old = [n for n in names if n.startswith("ask-")][:-1]
        told = [n for n in names if n.startswith(f"told-{query}-")]
        old += [n for n in told if int(n.rpartition("-")[2]) < batch_id - 1]
        for path in (answers, *(f"{self.inbox}/{n}" for n in old)):
            self.files.delete(path)

    def _told(self, query: str, batch_id: int) -> str:
        return f"{self.inbox}/told-{query}-{batch_id}"

    def _clock(self) -> int:
        """The latest time of all questions so far."""
        times = [int(n.split("-")[1]) for n in self.files.children(self.inbox) if n.startswith("ask-")]
        return max(times, default=0)

    def _put(self, messages: DataFrame, path: str, clock: int) -> None:
        for name, kind in (("open", "bigint"), ("last", "bigint"), ("seen", "map<string, bigint>"), ("asked", "string")):
            if name not in messages.columns:
                messages = messages.withColumn(name, F.lit(None).cast(kind))
        stamped = messages.withColumn("clock", F.timestamp_millis(F.lit(clock)))
        stamped.select("key", "open", "last", "seen", "asked", "clock").write.mode("overwrite").parquet(path)

    def _merge(self, answers: str) -> None:
        """Run the state query over all messages that it has not seen."""
        spark = self.spark.newSession()
        for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            spark.conf.set(name, self.spark.conf.get(name))
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        messages = spark.readStream.schema(self.message).option("cleanSource", "delete").parquet(f"{self.inbox}/*")
        # The clock never falls; messages at the watermark itself would count as late.
        merged = (
            messages.withWatermark("clock", "1 millisecond")
            .groupBy("key")
            .transformWithState(
                Latest(self.idle_ms), f"key {self.kind}, {STATE}, asked string", "Update", "EventTime"
            )
        )

        def store(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{answers}/{number}")

        query = merged.writeStream.foreachBatch(store).outputMode("update")
        query.option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start().awaitTermination()

"""Streaming forms of the access summary, detail sample and rate limit.

Each micro-batch is worked on by the batch operators, which split a key that has most of
the rows; what they need to know of earlier batches is kept per key in a state store.
Rows that come late count: a late request is taken at the latest time its key has been
seen.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.operators.access import (
    COUNTERS,
    DETAIL_LIMIT,
    DETAIL_MS,
    SUMMARY_MS,
    counters,
    interval_start,
)
from tradelake.operators.admission import admit
from tradelake.session import written
from tradelake.sources.files import Files
from tradelake.streaming.keyed import KeyedState
from tradelake.streaming.state import each_batch

SUMMARY = "node_id {node}, interval_start_ms bigint, " + ", ".join(
    f"{name} bigint" for name in COUNTERS.values()
)
#: A client that has been silent this long is forgotten; its bucket is full by then.
IDLE_MS = 3_600_000
NEVER_MS = 1 << 50
#: An interval is kept open for events that come so much later than the newest one.
LATE_MS = 60_000
NOTHING_SEEN = "CAST(map() AS map<string, bigint>)"


def _kind(rows: DataFrame, name: str) -> str:
    return rows.schema[name].dataType.simpleString()


# Summary


def start_summary(
    events: DataFrame,
    path: str,
    checkpoint: str,
    start_ms: int,
    interval_ms: int = SUMMARY_MS,
    late_ms: int = LATE_MS,
) -> StreamingQuery:
    """Count events per interval in event time; see :func:`read_summary`.

    An interval is written once, when event time has passed its end by ``late_ms``.
    Events that come after that are counted apart, as corrections of their interval.
    Intervals that are open are in the query's state store and nowhere else.
    """
    names = list(COUNTERS.values())
    timed = events.filter(F.col("kind").isin(list(COUNTERS))).withColumn("at", F.timestamp_millis("at_ms"))
    timed = timed.withWatermark("at", f"{late_ms} milliseconds")
    offset = f"{start_ms % interval_ms} milliseconds"
    window = F.window("at", f"{interval_ms} milliseconds", f"{interval_ms} milliseconds", offset)
    began = F.unix_millis("window.start").alias("interval_start_ms")
    closed = timed.groupBy("node_id", window).agg(*counters()).select("node_id", began, *names, F.lit(False).alias("late"))
    ones = [(F.col("kind") == kind).cast("bigint").alias(name) for kind, name in COUNTERS.items()]
    came = timed.select("node_id", interval_start(start_ms, interval_ms), *ones, F.lit(True).alias("late"))

    def work(batch: DataFrame, query: str, batch_id: int) -> None:
        spark = batch.sparkSession
        Files(spark, path).write_text(f"{path}/queries/{query}", checkpoint)
        passed = _late_before(spark, checkpoint, batch_id)
        # Of the events themselves only those count here that Spark has left out as late.
        due = batch.filter(~F.col("late") | (F.col("interval_start_ms") + interval_ms <= passed))
        sums = [F.sum(name).alias(name) for name in names]
        counted = due.groupBy("node_id", "interval_start_ms", "late").agg(*sums)
        counted.write.mode("overwrite").parquet(f"{path}/intervals/query={query}/batch={batch_id}")

    return each_batch(closed.unionByName(came), checkpoint, work)


def _late_before(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The event time up to which a batch's intervals are closed: Spark judges lateness
    by the watermark of the batch before, which the offset log holds."""
    if batch_id == 0:
        return 0
    text = spark.read.text(f"{checkpoint}/offsets/{batch_id - 1}", wholetext=True).first()[0]
    return json.loads(text.splitlines()[1])["batchWatermarkMs"]


def written_intervals(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """Closed intervals and corrections (``late``), each as its batch has counted it."""
    schema = SUMMARY.format(node=_kind(events, "node_id")) + ", late boolean"
    if not Files(spark, path).children(f"{path}/intervals"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/intervals/query=*/batch=*")


def open_intervals(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """The counts so far of the intervals that are not closed, from the state stores."""
    found = spark.createDataFrame([], SUMMARY.format(node=_kind(events, "node_id")))
    for query in Files(spark, path).children(f"{path}/queries"):
        checkpoint = spark.read.text(f"{path}/queries/{query}").first()[0]
        if not Files(spark, checkpoint).children(f"{checkpoint}/commits"):
            continue
        state = spark.read.format("statestore").load(checkpoint)
        # The store calls every count "count"; they come in the order of the counters.
        named = ", ".join(f"{name}: bigint" for name in COUNTERS.values())
        began = F.unix_millis("key.window.start").alias("interval_start_ms")
        found = found.unionByName(
            state.select("key.node_id", began, F.col("value").cast(f"struct<{named}>").alias("n"))
            .select("node_id", "interval_start_ms", "n.*")
        )
    return found


def read_summary(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """The counts of every interval of ``events`` so far: closed ones, their corrections
    and the open ones."""
    both = written_intervals(spark, path, events).drop("late").unionByName(open_intervals(spark, path, events))
    sums = [F.sum(name).alias(name) for name in COUNTERS.values()]
    return both.groupBy("node_id", "interval_start_ms").agg(*sums)


# Rate limit and sample


def _not_before(rows: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``at``: their time, or the last time of their key if that is later."""
    known = state.select(F.col(key).alias("_key"), F.col("last").alias("_last"))
    joined = rows.join(known, F.col(key).eqNullSafe(F.col("_key")), "left")
    at = F.greatest("at_ms", F.coalesce("_last", "at_ms"))
    return joined.withColumn("at", at).drop("_key", "_last")


def _admitted(rows: DataFrame, state: DataFrame, key: str, *rule, **options) -> DataFrame:
    """:func:`admit` by ``at``, going on from the state; ``rows`` keep their own time."""
    timed = _not_before(rows, state, key)
    timed = timed.withColumnRenamed("at_ms", "own_ms").withColumnRenamed("at", "at_ms")
    found = admit(timed, key, *rule, openings=state.select(key, "open"), **options)
    return found.withColumnRenamed("at_ms", "at").withColumnRenamed("own_ms", "at_ms")


def _stored(spark: SparkSession, path: str, query: str, batch_id: int, rows: DataFrame) -> DataFrame:
    """The batch's answers, written once under its own name."""
    out = f"{path}/query={query}/batch={batch_id}"
    rows.write.mode("overwrite").parquet(out)
    return spark.read.schema(rows.schema).parquet(out)


def _kept(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    idle_ms: int,
    judged: Callable[[DataFrame, DataFrame], DataFrame],
    states: Callable[[DataFrame, DataFrame], DataFrame],
) -> StreamingQuery:
    """Store what ``judged`` says of every micro-batch and the states before it, and tell
    ``states`` of these answers and the batch to the keyed state.

    A batch that is run again finds the state as it was before it. Answers are written
    before states are told; a batch whose states are all told is done.
    """
    kind = _kind(stream, key)

    def work(batch: DataFrame, query: str, batch_id: int) -> None:
        spark = batch.sparkSession
        state = KeyedState(spark, f"{path}/state", key, kind, idle_ms)
        if state.is_done(query, batch_id):
            return
        # The batch is read several times below, its source once.
        rows = written(batch, "arrived")
        before = state.ask(rows, query, batch_id)
        answers = _stored(spark, f"{path}/answers", query, batch_id, judged(rows, before))
        state.tell(states(answers, rows), query, batch_id)

    return each_batch(stream, checkpoint, work)


def start_rate_limit(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    max_requests: int = 500,
    window_ms: int = 10_000,
    idle_ms: int = IDLE_MS,
) -> StreamingQuery:
    """Store every request with ``allowed``, keeping two numbers per client.

    A client is forgotten after ``idle_ms`` of silence. Its bucket must be full by
    then, so that is at least ``window_ms``.
    """
    if idle_ms < window_ms:
        raise ValueError(f"a bucket is full after {window_ms} ms; idle_ms is {idle_ms}")

    def judged(rows: DataFrame, before: DataFrame) -> DataFrame:
        flagged = _admitted(rows, before, "client", max_requests, window_ms)
        return flagged.withColumnRenamed("admitted", "allowed").drop("window_start_ms")

    def states(answers: DataFrame, rows: DataFrame) -> DataFrame:
        latest = [F.max("open").alias("open"), F.max("at").alias("last")]
        return answers.groupBy("client").agg(*latest).withColumn("seen", F.expr(NOTHING_SEEN))

    return _kept(requests, path, checkpoint, "client", idle_ms, judged, states)


def start_access_sample(
    events: DataFrame,
    path: str,
    checkpoint: str,
    start_ms: int,
    window_ms: int = DETAIL_MS,
    limit: int = DETAIL_LIMIT,
) -> StreamingQuery:
    """Store the sampled detail of access events, keeping a few numbers per node.

    Nodes are few and none is forgotten: the last window of a silent one still counts.
    """

    def judged(rows: DataFrame, before: DataFrame) -> DataFrame:
        windows = _admitted(
            rows, before, "node_id", 1, window_ms, first_open_ms=start_ms + window_ms
        )
        order = Window.partitionBy("node_id", "window_start_ms", "kind").orderBy("at", "seq")
        numbered = windows.withColumn("nth", F.row_number().over(order).cast("bigint"))
        first = numbered.filter(F.col("nth") <= limit).drop("admitted", "open")
        known = before.select(
            F.col("node_id").alias("_node"),
            (F.col("open") - window_ms).alias("_began"),
            F.col("seen").alias("_seen"),
        )
        goes_on = F.col("node_id").eqNullSafe(F.col("_node")) & (
            F.col("window_start_ms") == F.col("_began")
        )
        already = F.coalesce(F.try_element_at("_seen", F.col("kind")), F.lit(0))
        return (
            first.join(known, goes_on, "left")
            .withColumn("nth", F.col("nth") + already)
            .filter(F.col("nth") <= limit)
            .drop("_node", "_began", "_seen")
        )

    def states(answers: DataFrame, rows: DataFrame) -> DataFrame:
        return _sampler_states(answers, rows, start_ms, window_ms)

    return _kept(events, path, checkpoint, "node_id", NEVER_MS, judged, states)


def _sampler_states(
    answers: DataFrame, rows: DataFrame, start_ms: int, window_ms: int
) -> DataFrame:
    """Last window, its counts and the last time of the nodes of a batch.

    A window's first event is sampled, so the answers show every window that began. A
    node without any only moves its time; the window before the start is the least.
    """
    counts = answers.groupBy("node_id", F.col("window_start_ms").alias("began"), "kind").agg(
        F.max("nth").alias("n")
    )
    windows = counts.groupBy("node_id", "began").agg(
        F.map_from_entries(F.collect_list(F.struct("kind", "n"))).alias("seen")
    )
    latest = windows.groupBy(F.col("node_id").alias("_node")).agg(
        F.max_by("seen", "began").alias("seen"), F.max("began").alias("began")
    )
    lasts = rows.groupBy("node_id").agg(F.max("at_ms").alias("last"))
    began = F.coalesce("began", F.lit(start_ms).cast("bigint"))
    return lasts.join(latest, F.col("node_id").eqNullSafe(F.col("_node")), "left").select(
        "node_id",
        (began + window_ms).alias("open"),
        "last",
        F.coalesce("seen", F.expr(NOTHING_SEEN)).alias("seen"),
    )


def read_answers(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """The stored answers of all batches."""
    return spark.read.schema(columns).parquet(f"{path}/answers/query=*/batch=*")

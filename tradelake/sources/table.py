"""The stored trades table.

A batch lands as one folder, named by its source (the streaming query) and number, so
writing it again replaces it. ``settle`` moves what has landed into ``data``, Parquet by
``dt``, and adds it to the flush log of those periods; it is run by every cleanup pass.
Late trades add a file to their period; a period is rewritten only when it has come to
consist of many files. A read takes the settled periods it needs and what has landed
since, so the folders it lists do not grow with the number of batches.

``dt`` is the first day of a stored period: a day, or a month or year for sparse data.
Periods are rewritten with Spark's dynamic partition overwrite. There is one writer of
settled periods at a time; a reader that meets a rewrite should retry.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradelake import schemas
from tradelake.functions.times import period_of_ms, period_start, utc_day
from tradelake.operators import reads
from tradelake.operators.bounds import merge_bounds, pair_bounds
from tradelake.operators.reads import TradeQuery
from tradelake.operators.upserts import latest, metadata_value
from tradelake.sources.exchanges import exchange_filter
from tradelake.sources.files import Files

_SETTLED = "source string, batch_id bigint"
#: A period of so many files is rewritten as a whole when more is added to it.
MANY_FILES = 32


@dataclass(frozen=True)
class TradeTable:
    spark: SparkSession
    root: str
    period_length: str = "day"

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def flushes(self) -> str:
        return f"{self.root}/flushes"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    # Reading

    def read(self) -> DataFrame:
        return self._read(self.periods())

    def _read(self, periods: list[dt.date]) -> DataFrame:
        """Settled rows of these periods, and all rows that have landed since."""
        settled = self._settled_rows(periods)
        landed = self._landed_names()
        if not landed:
            return settled
        return settled.filter(~_came_with(landed)).unionByName(self._landed_rows(landed))

    def _settled_rows(self, periods: list[dt.date]) -> DataFrame:
        # Naming the directories spares Spark from listing the whole table.
        if not periods:
            return self.spark.createDataFrame([], schemas.STORED_TRADES)
        paths = [f"{self.data}/dt={start}" for start in periods]
        reader = self.spark.read.schema(schemas.STORED_TRADES)
        return reader.option("basePath", self.data).parquet(*paths)

    def _landed_names(self) -> list[str]:
        """Landed batches that are complete and not settled yet."""
        files, done = self._files(), self._settled_batches()
        return [
            name
            for name in files.children(self.landing)
            if files.exists(f"{self.landing}/{name}/_SUCCESS")
            and _number(name) > done.get(_source(name), -1)
        ]

    def _landed_rows(self, names: list[str], whole: bool = True) -> DataFrame:
        schema = f"{schemas.STORED_TRADES}, whole boolean"
        if not names:
            return self.spark.createDataFrame([], schemas.STORED_TRADES)
        found = self.spark.read.schema(schema).parquet(*[f"{self.landing}/{n}" for n in names])
        return found.filter(F.col("whole") == whole).drop("whole")

    def between(self, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
        """Trades within inclusive bounds, reading only the periods they touch."""
        first = dt.date.min if from_ms is None else self.period_of(from_ms)
        last = dt.date.max if to_ms is None else self.period_of(to_ms)
        rows = self._read([start for start in self.periods() if first <= start <= last])
        if from_ms is not None:
            rows = rows.filter(F.col("ts") >= from_ms)
        if to_ms is not None:
            rows = rows.filter(F.col("ts") <= to_ms)
        return rows

    def for_query(self, query: TradeQuery) -> DataFrame:
        """The fewest periods sure to hold a query's rows.

        The flush log between the query's bounds says how many trades the pair has
        per settled period. The period that a bound cuts counts as empty, so no
        period is left out that could matter.
        """
        ends = [self.period_of(ms) for ms in (query.from_ms, query.to_ms) if ms is not None]
        first = dt.date.min if query.from_ms is None else ends[0]
        last = dt.date.max if query.to_ms is None else ends[-1]
        live = [start for start in self.periods() if first <= start <= last]
        if query.limit is None:
            return self._read(live)
        wanted = (F.col("exchange") == exchange_filter(query.venue, query.market)) & (
            F.col("symbol") == query.symbol.lower()
        )
        counts = dict(
            self._log(live).filter(wanted).groupBy("dt").agg(F.sum("trades")).collect()
        )
        needed, found = [], 0
        for start in sorted(live, reverse=query.from_ms is None):
            if found < query.limit:
                needed.append(start)
                found += 0 if start in ends else counts.get(start, 0)
        return self._read(needed)

    def read_trades(self, query: TradeQuery) -> DataFrame:
        return reads.read_trades(self.for_query(query), query)

    def export_trades(self, query: TradeQuery) -> DataFrame:
        return reads.export_trades(self.for_query(query), query)

    def read_flushes(self) -> DataFrame:
        """Stored trades per period and pair, in one row for each time some were added."""
        log, landed = self._log(self.periods()), self._landed_names()
        if not landed:
            return log
        return log.unionByName(_totals(self._landed_rows(landed)))

    def _log(self, periods: list[dt.date]) -> DataFrame:
        if not periods:
            return self.spark.createDataFrame([], schemas.FLUSH_LOG)
        paths = [f"{self.flushes}/dt={start}" for start in periods]
        reader = self.spark.read.schema(schemas.FLUSH_LOG)
        return reader.option("basePath", self.flushes).parquet(*paths)

    def read_bounds(self) -> DataFrame:
        """First and last time of every stored pair, without scanning settled trades."""
        logged = self._log(self.periods()).select("exchange", "symbol", "earliest", "latest")
        return merge_bounds(pair_bounds(self._landed_rows(self._landed_names())), logged)

    def read_rejects(self) -> DataFrame:
        """Rows with a null, which were set aside, with the batch they came with."""
        settled = self.spark.createDataFrame([], schemas.STORED_TRADES)
        if self._files().exists(self.rejects):
            settled = self.spark.read.schema(schemas.STORED_TRADES).parquet(self.rejects)
        return settled.unionByName(self._landed_rows(self._landed_names(), whole=False))

    def stored_bytes(self) -> int:
        """Size of the stored files."""
        return self._files().size(self.data) + self._files().size(self.landing)

    def period_of(self, ms: int) -> dt.date:
        return period_of_ms(ms, self.period_length)

    def period(self, start: dt.date) -> DataFrame:
        return self._read([held for held in self.periods() if held == start]).filter(
            F.col("dt") == F.lit(start)
        )

    def periods(self) -> list[dt.date]:
        """Settled periods, oldest first."""
        names = self._files().children(self.data)
        return sorted(dt.date.fromisoformat(name[3:]) for name in names if name[:3] == "dt=")

    # Writing

    def append(
        self, trades: DataFrame, batch_id: int, flushed_at: int, source: str = "batch"
    ) -> int:
        """Store one batch of a source; its numbers must rise. Writing a batch again
        replaces it, and does nothing once it has been settled. Rows with a null are
        kept as rejects. Gives the number of trades stored.
        """
        if batch_id <= self._settled_batches().get(source, -1):
            return 0
        whole = F.lit(True)
        for name in schemas.TRADE_COLUMNS:
            whole = whole & F.col(name).isNotNull()
        rows = trades.select(
            *schemas.TRADE_COLUMNS,
            F.lit(source).alias("source"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(flushed_at).cast("bigint").alias("flushed_at"),
            period_start(utc_day(F.col("ts")), self.period_length).alias("dt"),
            whole.alias("whole"),
        )
        counted = Observation()
        rows = rows.observe(counted, F.count_if("whole").alias("stored"))
        rows.write.mode("overwrite").parquet(f"{self.landing}/{source}-{batch_id}")
        return counted.get["stored"]

    def settle(self) -> None:
        """Move what has landed into its periods. Running it again is harmless.

        New rows are added to the files of their periods, then to the flush log. The
        batches are marked as settled, then dropped. Periods that hold rows of these
        batches already were added to by a pass that was cut short: they are rewritten
        with these rows replaced, as are periods of many files.
        """
        files, landed = self._files(), self._landed_names()
        if landed:
            fresh = self._landed_rows(landed)
            touched = [row[0] for row in fresh.select("dt").distinct().collect()]
            held = self._settled_rows([start for start in self.periods() if start in touched])
            # Stored batches are older than new ones: the files' statistics rule them out.
            mine = held.filter(F.col("batch_id") >= min(map(_number, landed))).filter(_came_with(landed))
            again = {row[0] for row in mine.select("dt").distinct().collect()}
            whole = [start for start in touched if start in again or self._has_many_files(start)]
            if whole:
                held = held.filter(F.col("dt").isin(whole))
                mine = fresh.filter(F.col("dt").isin(whole))
                self._rewrite(held.filter(~_came_with(landed)).unionByName(mine), whole)
            if len(whole) < len(touched):
                added = fresh.filter(~F.col("dt").isin(whole)) if whole else fresh
                self._store(added, self.data, ["dt"], "append")
                self._store(_totals(added), self.flushes, ["dt"], "append")
            bad = self._landed_rows(landed, whole=False)
            self._store(bad, self.rejects, ["source", "batch_id"], "overwrite")
            done = self._settled_batches()
            for name in landed:
                done[_source(name)] = max(_number(name), done.get(_source(name), -1))
            rows = self.spark.createDataFrame(sorted(done.items()), _SETTLED)
            marks = len(files.children(f"{self.root}/settled"))
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/settled/{marks:012d}")
        for name in files.children(self.landing):
            if _number(name) <= self._settled_batches().get(_source(name), -1):
                files.delete(f"{self.landing}/{name}")

    def _has_many_files(self, start: dt.date) -> bool:
        names = self._files().children(f"{self.data}/dt={start}")
        return sum(name.endswith(".parquet") for name in names) >= MANY_FILES

    def _rewrite(self, rows: DataFrame, periods: list[dt.date]) -> None:
        """Replace whole periods, then their flush log."""
        self._store(rows, self.data, ["dt"], "overwrite")
        live = [start for start in self.periods() if start in periods]
        self._store(_totals(self._settled_rows(live)), self.flushes, ["dt"], "overwrite")

    def drop_period(self, start: dt.date) -> None:
        for part in (self.data, self.flushes):
            self._files().delete(f"{part}/dt={start}")

    def replace_period(self, start: dt.date, rows: DataFrame) -> None:
        """Rewrite a settled period with ``rows``, which may read the period itself."""
        if rows.isEmpty():
            self.drop_period(start)
        else:
            self._rewrite(rows, [start])

    def _settled_batches(self) -> dict[str, int]:
        """The last settled batch of every source."""
        marks = f"{self.root}/settled"
        whole = [
            name
            for name in sorted(self._files().children(marks))
            if self._files().exists(f"{marks}/{name}/_SUCCESS")
        ]
        if not whole:
            return {}
        return dict(self.spark.read.schema(_SETTLED).parquet(f"{marks}/{whole[-1]}").collect())

    @staticmethod
    def _store(rows: DataFrame, path: str, partition_by: list[str], mode: str) -> None:
        # The rebalance hint lets AQE split a directory that holds most of the rows.
        levels = [F.col(name) for name in partition_by]
        inner = [name for name in ("exchange", "symbol", "ts") if name in rows.columns]
        (
            rows.hint("rebalance", *levels)
            .sortWithinPartitions(*partition_by, *inner)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path)
        )

    def _files(self) -> Files:
        return Files(self.spark, self.root)


def _source(name: str) -> str:
    return name.rpartition("-")[0]


def _number(name: str) -> int:
    return int(name.rpartition("-")[2])


def _came_with(names: list[str]) -> Column:
    """Rows of these batches; there are as many as have landed since the last pass."""
    return F.concat_ws("-", "source", "batch_id").isin(names)


def _totals(trades: DataFrame) -> DataFrame:
    return trades.groupBy("exchange", "symbol", "dt").agg(
        F.count(F.lit(1)).alias("trades"),
        F.min("ts").alias("earliest"),
        F.max("ts").alias("latest"),
        F.max("flushed_at").alias("flushed_at"),
    )


@dataclass(frozen=True)
class MetadataTable:
    """Key-value settings kept as an append-only log; the last write wins."""

    spark: SparkSession
    path: str

    def set(self, key: str, value: str, seq: int) -> None:
        row = self.spark.createDataFrame(
            [(key, value, seq)], "key string, value string, seq bigint"
        )
        row.coalesce(1).write.mode("append").parquet(self.path)

    def get(self, key: str) -> str | None:
        schema = "key string, value string, seq bigint"
        if not Files(self.spark, self.path).exists(self.path):
            return None
        log = self.spark.read.schema(schema).parquet(self.path)
        found = metadata_value(latest(log, ["key"], "seq"), key).first()
        return found and found["value"]

"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import BLANK, word_count, written

#: Steps of the additive golden-ratio sequence: one step, and 2**20 steps at once.
GOLDEN = (math.sqrt(5) - 1) / 2
LOW_BITS = 20
GOLDEN_HIGH = 0.607787409740351
#: Cells of the unit interval by which points find their source.
CELLS = 4096
#: Documents of a bucket, in which a source's stream is put in order.
BUCKET = 1000


def _sources(
    buckets: DataFrame, weights: Sequence[int], share: float, repeats: float, block_words: int
) -> DataFrame:
    """One row per source: its number, size, target and blocks.

    Targets fill up like water: each source gets its weight times one common level,
    or ``repeats`` times its size where that is less, and the level is such that
    they add up to ``share`` of all sizes.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("ratio", "sid")
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int")
    )
    found = (
        buckets.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.lit(float(repeats)) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    before = F.coalesce(
        F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    found = found.withColumn("level", (total - before) / left).withColumn(
        "water", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    )
    found = found.withColumn(
        "target", F.least("cap", F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    ).withColumn("goal", F.least(F.round("target"), F.floor("cap")).cast("long"))
    found = found.withColumn("blocks", F.ceil(F.col("goal") / block_words))
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    return found.select(
        "sid", "source", "source_size", "target", "goal", "blocks", F.sum("blocks").over(upto).alias("upto")
    )


def _drawn(sources: DataFrame, count: int, total: int) -> DataFrame:
    """The first ``count`` slots with their sources: slot i's point is the fractional part
    of i times the golden ratio, and the source whose part of the cumulative blocks holds
    the point gets the slot."""
    low, high = F.col("slot") % (1 << LOW_BITS), F.floor(F.col("slot") / (1 << LOW_BITS))
    at = (low * F.lit(GOLDEN) + high * F.lit(GOLDEN_HIGH)) % F.lit(1.0)
    scale = CELLS / float(total)
    points = (
        sources.sparkSession.range(count)
        .select(F.col("id").alias("slot"))
        .withColumn("place", at * F.lit(float(total)))
        .withColumn("cell", F.floor(F.col("place") * scale))
    )
    parts = sources.filter("blocks > 0").select(
        "sid", "blocks", (F.col("upto") - F.col("blocks")).alias("from"), "upto"
    )
    cells = F.sequence(F.floor(F.col("from") * scale) - 1, F.floor(F.col("upto") * scale) + 1)
    return (
        points.join(parts.withColumn("cell", F.explode(cells)), "cell")
        .filter((F.col("place") >= F.col("from")) & (F.col("place") < F.col("upto")))
        .select("sid", "blocks", "slot")
    )


def schedule(sources: DataFrame) -> DataFrame:
    """The schedule: (sid, block, slot), where a source's n-th slot holds its n-th block.

    It is as long as it takes to give every source a slot for each of its blocks: its
    length is doubled until that is so, which the evenness of the points makes once or
    twice. Ranks come from counts per run of slots, so that a source with most slots is
    no single group.
    """
    spark = sources.sparkSession
    nothing = spark.createDataFrame([], "sid int, block long, slot long")
    total, n = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count_if(F.col("blocks") > 0)).first()
    if not total:
        return nothing
    count = int(total * 1.02) + 64 * n
    while True:
        drawn = _drawn(sources, count, total).withColumn("run", F.expr(f"slot div {max(256, math.isqrt(count))}L"))
        counts = written(drawn.groupBy("sid", "run").agg(F.count("*").alias("n"), F.max("blocks").alias("blocks")), "mix-runs")
        served = counts.groupBy("sid").agg((F.sum("n") >= F.max("blocks")).alias("enough"))
        if served.filter("enough").count() == n:
            break
        count *= 2
    before = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.select("sid", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("sid", "run").orderBy("slot")
    return (
        drawn.join(runs, ["sid", "run"])
        .withColumn("block", F.col("before") + F.row_number().over(within) - 1)
        .filter("block < blocks")
        .select("sid", "block", "slot")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    repeats: float = 2.0,
    block_words: int = 256,
) -> DataFrame:
    """How much of every document a mix of its sources takes.

    Sources in code point order (null last) weigh ``weights``, repeating; targets
    add up to ``share`` times all words, none above ``repeats`` times its source.
    Each source's documents are shuffled by the MD5 of their ids and texts into one
    stream of words, read again from its start where the target asks for more, and cut
    into blocks of ``block_words``. A golden-ratio sequence deals the slots of the mix to
    the sources, and a source's n-th slot takes its n-th block; the last one ends at its
    target. What no slot takes is not in the mix.

    Columns: ``row`` (the document, all its columns), ``source``, ``size``,
    ``source_size``, ``target``, ``taken``, ``first_slot`` and ``parts``: for each
    reading of the document its ``turn``, the ``words`` taken from its start and the
    ``slot`` that takes the first of them. A null or blank text has size 0 and is not
    taken; null sources are one source; equal rows are taken each on its own; an empty
    table gives no rows.
    """
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    own = docs.select(
        F.struct("*").alias("row"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(identity.cast("binary")).alias("turn"),
        F.col("doc_id").alias("id"),
    )
    # Buckets of about BUCKET documents, however many there are.
    digits = max(1, math.ceil(math.log(max(docs.count(), 1) / BUCKET, 16)))
    own = own.withColumn("bucket", F.substring("turn", 1, digits))
    buckets = written(
        own.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-buckets"
    )
    sources = written(_sources(buckets, weights, share, repeats, block_words).coalesce(1), "mix-sources")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.join(sources, same(buckets, sources)).select(
        F.col("sid"), F.col("bucket"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("bucket_start")
    )
    within = (
        Window.partitionBy("sid", "bucket")
        .orderBy("turn", F.col("id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = (
        own.join(sources, same(own, sources))
        .select("row", own["source"], "size", "turn", "id", "bucket", "sid", "source_size", "target", "goal")
        .join(starts, ["sid", "bucket"])
        .withColumn("start", F.col("bucket_start") + F.sum("size").over(within) - F.col("size"))
    )
    turns = F.array(F.lit(0), F.col("source_size"))
    pieces = (
        placed.filter("size > 0")
        .select("sid", "start", "size", "goal", F.posexplode(turns).alias("turn", "turn_start"))
        .withColumn("from", F.col("turn_start") + F.col("start"))
        .withColumn("to", F.least(F.col("from") + F.col("size"), F.col("goal")))
        .filter("from < to")
        .withColumn(
            "block",
            F.explode(F.expr(f"sequence(`from` div {block_words}, (`to` - 1) div {block_words})")),
        )
        .select(
            "sid",
            "start",
            "turn",
            "block",
            (
                F.least(F.col("to"), (F.col("block") + 1) * block_words)
                - F.greatest(F.col("from"), F.col("block") * block_words)
            ).alias("words"),
        )
    )
    taken = (
        pieces.join(schedule(sources), ["sid", "block"])
        .groupBy("sid", F.col("start").alias("place"))
        .agg(
            F.sum("words").alias("taken"),
            F.min("slot").alias("first_slot"),
            *[
                agg(F.when(F.col("turn") == turn, F.col(name))).alias(f"{name}{turn}")
                for turn in (0, 1)
                for agg, name in ((F.sum, "words"), (F.min, "slot"))
            ],
        )
    )
    part = lambda n: F.struct(F.lit(n).alias("turn"), F.col(f"words{n}").alias("words"), F.col(f"slot{n}").alias("slot"))
    taken = taken.select(
        "sid", "place", "taken", "first_slot",
        F.filter(F.array(part(0), part(1)), lambda p: p["words"].isNotNull()).alias("parts"),
    )
    # An empty document shares its start with the next one: give it a place that no block has.
    place = F.when(F.col("size") > 0, F.col("start")).otherwise(-1 - F.crc32("turn"))
    return (
        placed.withColumn("place", place)
        .join(taken, ["sid", "place"], "left")
        .select(
            "row", "source", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot", "parts",
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs`` and in the order of its schedule.

    A document comes once for each time it is read, cut after its last taken word; rows
    are range-partitioned and sorted by the slot that takes their first word.
    """
    copies = (
        mix(docs, **options)
        .select("row", "size", F.explode("parts").alias("part"))
        .select("row", "size", "part.words", "part.slot")
        .repartitionByRange("slot")
        .sortWithinPartitions("slot")
    )
    # Cut before each blank that follows a word, so that blanks stay as they are.
    pieces = F.split("row.text", f"(?<=[^\\x20\\x09-\\x0D])(?={BLANK})")
    text = F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    )
    cut = copies.withColumn("cut", text)
    changed = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return cut.select(*[
        (F.when(F.col("words") == F.col("size"), F.col("row")[name]).otherwise(changed[name])
         if name in changed else F.col("row")[name]).alias(name)
        for name in docs.columns
    ])


#: The mix of ``documents`` with its production parameters, in DuckDB SQL.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS turn,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
c AS (SELECT *, [3, 1, 2][(sid - 1) % 3 + 1] AS weight, 2e0 * source_size AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio FROM c),
l AS (SELECT *, (1.5e0 * (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY ratio, sid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY ratio, sid
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT *, least(cap, coalesce((SELECT max(level) FROM l WHERE level <= ratio) * weight, cap))
    AS target FROM l),
g AS (SELECT *, least(round(target), floor(cap))::BIGINT AS goal FROM t),
h AS (SELECT *, ceil(goal / 256e0)::BIGINT AS blocks FROM g),
u AS (SELECT *, sum(blocks) OVER (ORDER BY sid)::BIGINT AS upto FROM h),
n AS (SELECT coalesce(sum(blocks), 0) AS total, 8 * coalesce(sum(blocks), 0)::BIGINT + 512 * count(*) AS slots FROM u),
p AS (SELECT slot, total * (((slot % {1 << LOW_BITS}) * {GOLDEN!r}::DOUBLE
    + (slot // {1 << LOW_BITS}) * {GOLDEN_HIGH!r}::DOUBLE) % 1e0) AS place
    FROM (SELECT unnest(range(slots)) AS slot, total FROM n)),
k AS (SELECT sid, slot, blocks, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block
    FROM p JOIN u ON place >= upto - blocks AND place < upto),
o AS (SELECT d.*, sid, source_size, target, goal, sum(size) OVER (PARTITION BY sid
    ORDER BY turn, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start
    FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
e AS (SELECT sid, start, first + start AS lo, least(first + start + size, goal) AS hi
    FROM (SELECT *, unnest([0, source_size]) AS first FROM o WHERE size > 0)),
b AS (SELECT *, unnest(range(lo // 256, (hi - 1) // 256 + 1)) AS block FROM e WHERE lo < hi),
a AS (SELECT b.sid, start, sum(least(hi, (block + 1) * 256) - greatest(lo, block * 256))::BIGINT AS taken,
    min(slot) AS first_slot FROM b JOIN (SELECT * FROM k WHERE block < blocks) k USING (sid, block)
    GROUP BY ALL)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot
FROM o LEFT JOIN a ON o.sid = a.sid AND o.start = a.start AND size > 0"""

"""Which pairs to track, from assets, whitelist templates and symbol catalogues.

The rule set asks, for every asset and template, whether the catalogue has a
ticker of that spelling. Enumerating assets x templates would be a cross product,
so the jobs go the other way: each catalogue ticker is taken apart into the
(base, quote) pairs it could stand for, and these meet assets and templates in
equi-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.symbols import ascii_upper, shown_name, ticker_format
from tradelake.session import written
from tradelake.sources.exchanges import exchanges

PAIR = ["exchange", "symbol"]


def wanted_quotes(whitelist: DataFrame) -> DataFrame:
    """Supported exchanges with their upper-case quotes; '' is the wildcard."""
    names = exchanges(whitelist.sparkSession).select("exchange", "venue", "market")
    rows = whitelist.select(
        F.lower("venue").alias("venue"), F.lower("market").alias("market"), "quote"
    )
    supported = rows.join(F.broadcast(names), ["venue", "market"])
    return supported.select("exchange", F.upper("quote").alias("quote")).distinct()


def candidate_tickers(pairs: DataFrame) -> DataFrame:
    """Add ``ticker``: the venue spelling of ``base`` and ``quote``."""
    names = exchanges(pairs.sparkSession).select("exchange", "joiner", "suffix")
    spelled = ticker_format(
        F.col("base"), F.col("quote"), F.col("joiner"), F.col("suffix")
    )
    joined = pairs.join(F.broadcast(names), "exchange")
    return joined.withColumn("ticker", spelled).drop("joiner", "suffix")


def _names(catalog: DataFrame) -> DataFrame:
    """Both spellings of every ticker that has trading information."""
    known = catalog.filter(F.col("has_info"))
    spellings = F.array(
        F.struct(F.col("symbol").alias("name"), F.lit(True).alias("internal")),
        F.struct(F.col("display_symbol").alias("name"), F.lit(False).alias("internal")),
    )
    names = known.select("exchange", "symbol", F.explode(spellings).alias("n"))
    return names.select("exchange", "symbol", "n.name", "n.internal").filter(
        "name IS NOT NULL"
    )


def _taken_apart(names: DataFrame) -> DataFrame:
    """Each way to read a ticker as base and quote under its venue's format.

    ``exact`` marks tickers spelled in upper case already. Tickers that are the
    base alone get a null quote.
    """
    formats = exchanges(names.sparkSession).select("exchange", "joiner", "suffix")
    spelled = names.select(
        "exchange",
        "symbol",
        ascii_upper(F.col("name")).alias("spelled"),
        (F.col("internal") & (F.col("name") == ascii_upper(F.col("name")))).alias("exact"),
    ).join(F.broadcast(formats), "exchange")
    alone = spelled.filter("joiner IS NULL").select(
        "exchange",
        "symbol",
        "exact",
        F.col("spelled").alias("base"),
        F.lit(None).cast("string").alias("quote"),
    )
    stems = spelled.filter("joiner IS NOT NULL AND endswith(spelled, suffix)").select(
        "exchange",
        "symbol",
        "exact",
        "joiner",
        F.expr("left(spelled, length(spelled) - length(suffix))").alias("stem"),
    )
    # The quote is never empty, so the last cut leaves one character after it.
    cuts = stems.filter("length(stem) > length(joiner)").withColumn(
        "cut", F.explode(F.expr("sequence(0, length(stem) - length(joiner) - 1)"))
    )
    joined = cuts.filter("substr(stem, cut + 1, length(joiner)) = joiner").select(
        "exchange",
        "symbol",
        "exact",
        F.expr("left(stem, cut)").alias("base"),
        F.expr("substr(stem, cut + length(joiner) + 1)").alias("quote"),
    )
    return joined.unionByName(alone)


def resolve_pairs(bases: DataFrame, whitelist: DataFrame, catalog: DataFrame) -> DataFrame:
    """Distinct (exchange, symbol) to track.

    A template's ticker is taken as spelled if the catalogue has it; only
    otherwise by its spelling without regard to case, in the ticker or in its
    display symbol (the smallest such ticker). A wildcard takes every ticker whose
    ticker or display symbol starts with the base. Tickers without trading
    information are never taken.
    """
    assets = written(bases.select(F.upper("base").alias("base")).distinct(), "assets")
    quotes = written(wanted_quotes(whitelist), "quotes")
    named = quotes.filter("quote <> ''")
    names = _names(catalog)

    # Lists of exchanges are at most as long as the exchange dimension.
    named_exchanges = named.select("exchange").distinct()
    open_exchanges = quotes.filter("quote = ''").select("exchange")

    parts = _taken_apart(names)
    with_quote = parts.filter("quote IS NOT NULL").join(named, ["exchange", "quote"], "left_semi")
    alone = parts.filter("quote IS NULL").join(
        F.broadcast(named_exchanges), "exchange", "left_semi"
    )
    fitting = with_quote.unionByName(alone).join(assets, "base", "left_semi")
    best = fitting.groupBy("exchange", "base", "quote").agg(
        F.min(F.struct((~F.col("exact")).alias("inexact"), "symbol")).alias("best")
    )
    templated = best.select("exchange", F.col("best.symbol").alias("symbol"))

    open_names = names.join(F.broadcast(open_exchanges), "exchange", "left_semi")
    starts = open_names.select(
        *PAIR,
        F.explode(
            F.expr("transform(sequence(0, length(name)), i -> left(upper(name), i))")
        ).alias("base"),
    )
    wild = starts.join(assets, "base", "left_semi").select(*PAIR)
    return templated.unionByName(wild).distinct()


def exchange_symbols(catalog: DataFrame) -> DataFrame:
    """Upper-case symbols on each exchange, in order, display names preferred.

    Tickers without trading information are listed too. ``listed`` says how often
    a symbol occurs, so duplicates are kept without one row per exchange.
    """
    shown = F.upper(shown_name(F.col("symbol"), F.col("display_symbol")))
    listed = catalog.groupBy("exchange", shown.alias("symbol")).agg(
        F.count(F.lit(1)).alias("listed")
    )
    return listed.orderBy(*PAIR)


def exchange_symbol_lists(catalog: DataFrame) -> DataFrame:
    """The nested answer: one sorted array per exchange, so one row for each.

    :func:`exchange_symbols` has the same content in rows.
    """
    listed = exchange_symbols(catalog)
    repeated = F.flatten(F.collect_list(F.expr("array_repeat(symbol, int(listed))")))
    return listed.groupBy("exchange").agg(F.array_sort(repeated).alias("symbols"))


def whitelist_exchanges(whitelist: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Exchanges a whitelist needs, per venue (and per ``by`` columns).

    A venue has at most three exchanges, so the sorted list is short.
    """
    keys = [*(by or []), "venue"]
    names = exchanges(whitelist.sparkSession).select("exchange", "venue", "market")
    rows = whitelist.select(
        *(by or []), F.lower("venue").alias("venue"), F.lower("market").alias("market")
    )
    wanted = rows.join(F.broadcast(names), ["venue", "market"])
    return wanted.groupBy(*keys).agg(
        F.array_sort(F.collect_set("exchange")).alias("exchanges")
    )


def all_exchanges(spark) -> DataFrame:
    """Discovery mode: every exchange, per venue."""
    return exchanges(spark).groupBy("venue").agg(
        F.array_sort(F.collect_set("exchange")).alias("exchanges")
    )

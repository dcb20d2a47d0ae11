"""Symbol spelling rules."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_upper(text: Column) -> Column:
    """Upper-case the 26 ASCII letters only."""
    return F.translate(text, string.ascii_lowercase, string.ascii_uppercase)


def shown_name(ticker: Column, display: Column) -> Column:
    """The display symbol when there is one, else the ticker."""
    return F.coalesce(display, ticker)


def stored_symbol(ticker: Column, display: Column) -> Column:
    """Spelling under which a trade is stored."""
    return F.lower(shown_name(ticker, display))


def ticker_format(base: Column, quote: Column, joiner: Column, suffix: Column) -> Column:
    """Venue spelling of a pair; a null joiner means the base stands alone."""
    pair = F.concat(F.upper(base), joiner, F.upper(quote), suffix)
    return F.when(joiner.isNull(), F.upper(base)).otherwise(pair)

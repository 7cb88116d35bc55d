"""Column expressions shared by the Silver and Gold steps.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none needs Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lower_trim(c) -> Column:
    return F.lower(F.trim(_c(c)))


def upper_trim(c) -> Column:
    return F.upper(F.trim(_c(c)))


def title_trim(c) -> Column:
    """Title case after trimming spaces; words split on spaces only."""
    return F.initcap(F.trim(_c(c)))


def to_timestamp_ntz(c) -> Column:
    """Zone-less timestamp from text; unparsable text becomes NULL.

    A plain cast raises under ANSI mode; the later mandatory-column filter
    is what removes such rows, so NULL is the wanted result.
    """
    return _c(c).try_cast("timestamp_ntz")


def guarded_rate(num, den, scale: int = 100) -> Column:
    """``den > 0 ? round(num * scale / den, 2) : 0.0``."""
    num, den = _c(num), _c(den)
    scaled = num * scale if scale != 1 else num
    return F.when(den > 0, F.round(scaled / den, 2)).otherwise(F.lit(0.0))


def coalesced_rate(num, den, scale: int = 100) -> Column:
    """``round(coalesce(num * scale / den, 0.0), 2)``; x/0 gives 0.0, never an error."""
    num, den = _c(num), _c(den)
    scaled = num * scale if scale != 1 else num
    return F.round(F.coalesce(F.try_divide(scaled, den), F.lit(0.0)), 2)


def surrogate_key(*parts) -> Column:
    """SHA-256 hex of the ``|``-joined grain values (dates as ISO text).

    ``concat_ws`` skips NULLs, so only non-null grains give distinct keys;
    the cleaning and the Gold quality rules guarantee that.
    """
    return F.sha2(F.concat_ws("|", *[_c(p).cast("string") for p in parts]), 256)


def days_late(ingested, event_date) -> Column:
    """Whole days between the event date and the ingestion date."""
    return F.datediff(F.to_date(_c(ingested)), _c(event_date))

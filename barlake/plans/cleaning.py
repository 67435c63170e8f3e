"""Raw bars to clean, flagged and adjusted bars, all instruments in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barlake.functions.columns import clean_numeric
from barlake.operators.adjust import adjust_prices, rename_qfq
from barlake.operators.calendar import calendar_align
from barlake.operators.series import (
    dedup_first,
    flag_extreme,
    flag_invalid_ohlc,
    flag_suspended,
    forward_fill,
    returns,
    zero_aligned_returns,
)


def clean_bars(
    bars: DataFrame,
    open_days: DataFrame | None = None,
    max_daily_pct: float = 15.0,
    order: str | None = "ingest_seq",
) -> DataFrame:
    """Dedup, numeric clean-up, calendar alignment, fills, returns and flags.

    ``order=None`` says that the bars are unique by instrument and day already, as a
    stored table is; that saves the shuffle of the deduplication and leaves one."""
    unique = dedup_first(bars, order=order).drop(order) if order else bars
    frame = clean_numeric(unique)
    if open_days is not None:
        frame = calendar_align(frame, open_days)
    frame = returns(flag_suspended(forward_fill(frame)))
    if "flag_aligned" in frame.columns:
        frame = zero_aligned_returns(frame)
    return flag_invalid_ohlc(flag_extreme(frame, max_daily_pct))


def clean_and_adjust(
    bars: DataFrame,
    factors: DataFrame | None,
    open_days: DataFrame | None = None,
    max_daily_pct: float = 15.0,
    order: str | None = "ingest_seq",
) -> DataFrame:
    """:func:`clean_bars`, then forward-adjusted prices as ``adj_*_qfq``."""
    cleaned = clean_bars(bars, open_days, max_daily_pct, order)
    return cleaned if factors is None else rename_qfq(adjust_prices(cleaned, factors, "qfq"))

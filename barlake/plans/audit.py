"""Source audit of the pool over the last days."""

from __future__ import annotations

from pyspark.sql import DataFrame

from datetime import date, timedelta

from barlake.operators.audit import audit_sources
from barlake.operators.universe import head_codes


def sampled_source_audit(
    pool: DataFrame,
    primary: DataFrame,
    secondary: DataFrame,
    end: str,
    audit_date: str,
    sample_size: int | None = None,
    lookback_days: int = 5,
    tolerance_pct: float = 1.0,
) -> DataFrame:
    """One grouped job over the whole pool, or its first ``sample_size`` codes; the codes
    reach both scans as a semi join."""
    codes = pool.select("ts_code").distinct() if sample_size is None else head_codes(pool, sample_size)
    start = (date.fromisoformat(end) - timedelta(days=lookback_days)).isoformat()
    return audit_sources(
        codes,
        primary,
        secondary,
        start,
        end,
        audit_date,
        tolerance_pct,
    )

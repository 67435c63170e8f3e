"""Price adjustment by cumulative factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barlake.functions.columns import ratio
from barlake.operators.series import dedup_first, fill_both_ways, whole_series
from barlake.schemas import BAR_KEY, PRICES


def join_factors(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Attach the factor of the same day; a factor on a day without a bar is not used.

    Of repeated factors of a day the one with the least ``ingest_seq`` counts, or the
    largest where the feed has no such order, so bars are never multiplied.  Any factor
    column of the bars is replaced."""
    if "ingest_seq" in factors.columns:
        each = dedup_first(factors.select(*BAR_KEY, "adj_factor", "ingest_seq")).drop("ingest_seq")
    else:
        each = factors.groupBy(*BAR_KEY).agg(F.max("adj_factor").alias("adj_factor"))
    return bars.drop("adj_factor").join(each, list(BAR_KEY), "left")


def with_factors(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Bars with their factor, carried over days without one, in both directions."""
    return fill_both_ways(join_factors(bars, factors), ["adj_factor"])


def adjust_prices(bars: DataFrame, factors: DataFrame | None, method: str = "hfq") -> DataFrame:
    """Add ``adj_open`` .. ``adj_close``.

    ``none`` copies the prices.  ``hfq`` scales by factor / first factor, ``qfq`` by
    factor / last factor; any other name means ``hfq``.  Factors are carried over days
    without one, in both directions.  Without factors the adjusted prices are NULL."""
    keeps_factor = bars if "adj_factor" in bars.columns else bars.withColumn("adj_factor", F.lit(None).cast("double"))
    if method == "none":
        return keeps_factor.withColumns({f"adj_{p}": F.col(p) for p in PRICES})
    if factors is None:
        return keeps_factor.withColumns({f"adj_{p}": F.lit(None).cast("double") for p in PRICES})
    filled = with_factors(bars, factors)
    anchor = (F.last if method == "qfq" else F.first)("adj_factor").over(whole_series())
    return (
        filled.withColumn("anchor", anchor)
        .withColumns({f"adj_{p}": ratio(F.col(p) * F.col("adj_factor"), F.col("anchor")) for p in PRICES})
        .drop("anchor")
    )


def rename_qfq(adjusted: DataFrame) -> DataFrame:
    """``adj_open`` -> ``adj_open_qfq`` and so on, as the bar table stores them."""
    return adjusted.withColumnsRenamed({f"adj_{p}": f"adj_{p}_qfq" for p in PRICES})

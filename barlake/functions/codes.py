"""Instrument codes: symbol, exchange, and the dotted ts_code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barlake.functions.columns import col_of

# First digit of a symbol -> exchange, and exchange -> code suffix.
EXCHANGE_BY_FIRST_DIGIT = {
    "6": "SSE",
    "0": "SZSE",
    "3": "SZSE",
    "4": "BSE",
    "8": "BSE",
    "9": "BSE",
}
SUFFIX_BY_EXCHANGE = {"SSE": "SH", "SZSE": "SZ", "BSE": "BJ"}


def zero_pad(value: Column | str, width: int = 6) -> Column:
    """Left-pad with zeros; longer values stay whole (``lpad`` alone would cut them)."""
    text = col_of(value).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def symbol_of(ts_code: Column | str) -> Column:
    return F.substring_index(col_of(ts_code), ".", 1)


def _lookup(key: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def exchange_of(symbol: Column | str) -> Column:
    """Exchange from the first digit; NULL for a prefix no exchange uses."""
    return _lookup(F.substring(col_of(symbol), 1, 1), EXCHANGE_BY_FIRST_DIGIT)


def suffix_of(symbol: Column | str) -> Column:
    return _lookup(exchange_of(symbol), SUFFIX_BY_EXCHANGE)


def ts_code_of(symbol: Column | str, default_suffix: str | None = "BJ") -> Column:
    """``symbol.suffix``.  Bar feeds file unknown prefixes under the default suffix; pass
    ``None`` to get NULL for them, as instrument lists need."""
    suffix = suffix_of(symbol)
    if default_suffix is not None:
        suffix = F.coalesce(suffix, F.lit(default_suffix))
    return F.concat(col_of(symbol), F.lit("."), suffix)

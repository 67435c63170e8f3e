"""DataFrame -> DataFrame operators.

Windows are per instrument and ordered by date.  After :func:`dedup.dedup_first` (or
when reading a key-enforced table) an instrument holds at most one row per day, so the
largest window is bounded by the number of days, however large the input is.
Duplicates are removed by an aggregation that combines on the map side, which is why a
hot instrument cannot pile up its copies in one task."""

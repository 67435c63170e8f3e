"""The queries the driver checks: market-data views over its tables, one Spark query per
operator, and the same query in SQL."""

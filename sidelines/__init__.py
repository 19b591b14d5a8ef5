"""Contest analytics on Spark: rolling form, rest, efficiency, feature tables, models and drift monitoring."""

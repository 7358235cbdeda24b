"""Daily e-commerce analytics on Spark: Bronze landing, Silver cleaning, Gold
aggregates and a star schema, all as ``DataFrame -> DataFrame`` functions."""

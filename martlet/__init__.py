"""Retail analytics on Spark: cleaning, star schema, named queries, basket rules, streams."""

"""Analytics for a rental business, written as Spark DataFrame pipelines."""

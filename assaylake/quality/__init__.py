"""Data-quality rules compiled to Spark aggregations."""

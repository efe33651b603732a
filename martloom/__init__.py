"""Data-mart operations as Spark DataFrame transformations."""

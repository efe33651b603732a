"""Named queries over the test tables, their inputs and their SQL twins."""

from martloom.plans import forecast_queries, metadata_queries, theme_queries

ALL_QUERIES = {**theme_queries.QUERIES, **metadata_queries.QUERIES, **forecast_queries.QUERIES}

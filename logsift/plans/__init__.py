"""End-to-end plans, SQL views, sinks and the query registry."""

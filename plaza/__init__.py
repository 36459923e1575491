"""Opinion-monitoring analytics on Spark: typed tables, gates, queries and streams as DataFrame operations."""

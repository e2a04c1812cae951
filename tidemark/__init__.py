"""Change-data analytics on Spark: change events in, replicas, marts and reports out."""

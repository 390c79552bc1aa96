"""A Spark engine for linking records of several sources."""

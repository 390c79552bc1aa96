"""Whole runs over the operators, and the queries with their SQL."""

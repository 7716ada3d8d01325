"""Snapshots of document tables, kept current from a log of changes, on Spark."""

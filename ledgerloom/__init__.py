"""Spark jobs that consolidate dirty business extracts and report on sales."""

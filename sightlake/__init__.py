"""Batch engine for geocoded incident reports, written as Spark DataFrame jobs."""

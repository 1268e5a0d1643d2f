"""Audit, balance and control checks for landed data, as Spark DataFrame jobs."""

"""Retail lakehouse analytics written as Spark DataFrame jobs."""

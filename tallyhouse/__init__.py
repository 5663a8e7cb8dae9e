"""Retail star-schema warehouse and analytics written as PySpark jobs."""

"""Retail-banking warehouse on Spark: staging, star schema, marts, measures, reports."""

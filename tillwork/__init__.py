"""Retail operations analytics on Spark: flatten, conform, enrich, compare, pivot, publish."""

"""Cleaning, quality checks, deduplication, table maintenance and analysis as DataFrames."""

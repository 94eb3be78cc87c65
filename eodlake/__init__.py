"""End-of-day market data on Spark: scan, clean, check, upsert, audit, report and query.

Import the modules directly; this file stays empty of imports because Spark's Python workers load it.
"""

__version__ = "0.1.0"

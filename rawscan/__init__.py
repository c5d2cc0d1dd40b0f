"""rawscan: ad-hoc relations over raw objects (NDJSON, delimited text, text, XML, listings) on Spark."""

__version__ = "0.1.0"

"""folioworks: build a clean, cross-linked content archive from a table of fetched web pages, on Spark."""

__version__ = "0.1.0"

"""Trusted star schemas from messy operational data, as plain Spark DataFrame plans."""

__version__ = "0.1.0"

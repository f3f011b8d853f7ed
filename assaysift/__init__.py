"""Cleaning and auditing of machine-extracted literature tables on Spark."""

from .schema import VERSION as __version__

__all__ = ["__version__"]

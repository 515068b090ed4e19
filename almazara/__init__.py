"""almazara: a Spark-first engine for irregular public data."""

__version__ = "0.1.0"

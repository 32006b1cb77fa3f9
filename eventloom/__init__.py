"""Event-observation linking, tiering and review routing as Spark DataFrame jobs."""

__version__ = "0.1.0"

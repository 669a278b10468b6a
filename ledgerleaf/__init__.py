"""Spark-first engine that turns laid-out fund-report pages into a holdings table."""

__version__ = "0.1.0"

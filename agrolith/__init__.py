"""Agrolith: a Spark-first engine for evidence-based assessments and for the data behind them."""

__version__ = "0.1.0"

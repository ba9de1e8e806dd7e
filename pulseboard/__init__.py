"""Real-time dashboard operators for Spark batch tables and Structured Streaming."""

__version__ = "0.1.0"

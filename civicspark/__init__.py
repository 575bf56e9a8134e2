"""Service-request analytics on Spark: labels, as-of features, gates, scoring and monitoring."""

__version__ = "0.1.0"

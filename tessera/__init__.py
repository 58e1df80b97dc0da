"""tessera: Spark-native refinement of chunked device telemetry (Bronze -> Silver)."""

__version__ = "0.1.0"

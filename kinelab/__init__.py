"""kinelab: sensor-window labelling, modelling and monitoring on Spark.

Packages: ``sources`` (tables, CSV, parquet, JSON), ``functions`` (scalar
expressions), ``operators`` (windows, as-of join, features, folds, model,
drift, registry, ops metrics), ``plans`` (the labelling pipeline and the
registered query catalog), ``streaming`` (Structured Streaming jobs).
"""

__all__ = ["config", "session"]

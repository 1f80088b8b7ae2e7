"""leadlake: a Spark-native lead-conversion lakehouse.

Messages -> bronze (partitioned parquet) -> silver (typed, deduplicated) ->
gold (imputed, bucketed, one-hot) -> model training/evaluation -> reporting.
Every step is a DataFrame-in / DataFrame-out function built on Spark SQL
expressions, so Catalyst plans it and the cluster runs it.
"""

__version__ = "0.1.0"

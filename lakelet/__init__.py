"""lakelet: everyday lakehouse work on Spark.

Feature tables with keyed upsert and lookup joins, windowed features, incremental
JSON/CSV ingestion with row rules, stream-static and stream-stream pipelines, SQL
reports with alerts, and regression training and batch scoring -- all expressed with
DataFrames, Spark SQL, Structured Streaming and Spark ML.
"""

from lakelet.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]

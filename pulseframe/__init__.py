"""Health-telemetry analytics on Spark DataFrames.

``functions``  column expressions
``operators``  DataFrame -> DataFrame
``sources``    CSV, stream payloads, the keyed record log, generated data
``sinks``      Parquet, CSV, JSON and catalog outputs
``streaming``  Structured Streaming jobs
``plans``      whole batch jobs (ETL, training, scoring, dashboard)
"""

__version__ = "0.1.0"

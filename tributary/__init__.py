"""tributary — complaint-channel landing, quality and modelling on Spark.

Sub-packages:
  functions/  scalar column expressions
  operators/  DataFrame -> DataFrame transforms (columns, metadata, quality)
  sources/    readers (files, JSON shapes, JDBC, catalog)
  sinks/      writers (partitioned Parquet, audit, warehouse tables)
  plans/      end-to-end jobs (landing, reference data, models)
  streaming/  file landing as Structured Streaming
"""

__version__ = "0.1.0"

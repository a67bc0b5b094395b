"""autolake: batch price analytics for priced listings and exchange rates on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from native Spark
expressions, so Catalyst plans the work and the executors run it.

Layout:
  sources/    bronze landing and reading, day partitions, keyed upserts, model registry
  operators/  cleaning, features, FX, page extraction, model and market queries
  functions/  reusable Column expressions and join/ranking helpers
  plans/      driver tables -> domain views, the query catalog, batch jobs
  streaming/  incremental ingest of bronze files with Structured Streaming
"""

__version__ = "0.1.0"

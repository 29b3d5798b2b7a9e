"""contrail: a Spark-native data-preparation, profiling and regression toolkit.

Sub-packages:
  sources    scans, merges, sinks, the driver tables and the ``trips`` view
  functions  Column -> Column expressions (tokens, tolerant casts, clock times)
  operators  cleaning, profiling, lookup joins, statistics, features, split, models
  plans      the two end-to-end pipelines and the query registry
  streaming  applying a fitted cleaning plan to a stream
"""

__version__ = "0.1.0"

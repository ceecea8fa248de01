"""dayframe: entity-by-day observation analytics as Spark DataFrame functions.

Layers (each a plain ``DataFrame -> DataFrame`` function, composed lazily so
Catalyst sees one plan per query):

* ``sources``   – readers for CSV / Parquet / JSON payloads, sinks and snapshots
* ``functions`` – Column helpers (keys, seasons, rounding, distance, slugs)
* ``operators`` – staging, flags, rollups, streaks, anomalies, range joins,
                  forecast alignment, nearest-location join, incremental
                  writers, reshapes, top-k and data-quality checks
* ``plans``     – the star-schema marts and dashboard datasets composed from
                  the operators, plus bindings to the benchmark tables
* ``streaming`` – Structured Streaming versions of the daily rollup
"""

__version__ = "0.1.0"

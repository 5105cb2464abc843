"""feeflow: fee-market event analytics on Spark DataFrames.

Layers (each a plain DataFrame -> DataFrame function on built-in Spark
expressions):

* ``sources``   capture scans, bronze copies, typed loads, sinks, fixtures
* ``functions`` column expressions (surrogate key, congestion class, alerts)
* ``operators`` parse, staging/dedup/upsert, features, marts, quantiles,
                serving queries, quality checks
* ``plans``     the model run (staging -> intermediate -> marts) and the
                query catalog used by ``__spark_entry__``
* ``streaming`` Structured Streaming forms of ingest, dedup and marts
"""

__version__ = "0.1.0"

"""fintide — wealth-management analytics as composable Spark DataFrame jobs.

Every public operator takes DataFrames (and plain parameters) and returns a
DataFrame, so jobs are chained with ``DataFrame.transform`` and planned as one
Catalyst plan.  Sub-packages:

* ``sources``   – CSV / lake / SQL-table I/O and the test-table views
* ``functions`` – Column-level helpers (buckets, scores, encodings, hashing)
* ``operators`` – cleaning, enrichment, portfolio roll-ups, reports, features,
                  model, scoring, transactions, time series, sampling
* ``streaming`` – Structured Streaming versions of scoring / monitoring / cache
* ``plans``     – the query catalogue used by ``__spark_entry__`` and bench
"""

__version__ = "0.1.0"

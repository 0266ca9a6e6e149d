"""demand: a PySpark-native demand-forecasting batch engine.

Every public function is ``DataFrame -> DataFrame`` (or a session plus
parameters -> DataFrame) and handles all series at once in one distributed
plan. Sub-packages:

* ``sources``   - warehouse scans, the test-data adapter, work-list CSV and
                  forecast-store readers/writers (append, keyed upsert).
* ``functions`` - Column-expression helpers (month keys, error terms, labels).
* ``operators`` - facts, work list, series layer, features, metrics, models,
                  summary record.
* ``plans``     - the two end-to-end jobs (work list, forecast).
* ``streaming`` - incremental processing of work-list files as they arrive.
"""

__all__ = ["session", "schemas", "sources", "functions", "operators", "plans", "streaming"]

"""starmart: star-schema analytics for order-processing data on Spark.

Layers (each a module of plain DataFrame functions):

* ``sources``   - source contracts and readers (parquet tables, typed CSV seeds)
* ``functions`` - reusable ``Column`` builders (money casts, surrogate keys, ratios, time grains)
* ``operators`` - staging, marts (dims / facts / rollup), calendar, incremental merge,
                  SCD2 history, data-quality checks
* ``plans``     - size-checked joins, the semantic (metric) layer, reports, full build
* ``streaming`` - the change-feed form of the SCD2 apply (Structured Streaming)
"""

__version__ = "0.1.0"

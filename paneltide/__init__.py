"""paneltide: panel time-series operators (entity x day x source x indicator) on PySpark.

Every operator is a plain function over ``Column`` / ``DataFrame`` values; the planner,
shuffle and storage are Spark's.  Sub-packages:

* ``functions``  - Column-level rules (R-style null handling, ladders, labels, dates)
* ``operators``  - DataFrame operators (reshape/densify, series windows, joins, aggregates)
* ``sources``    - readers with explicit schemas, the driver-table binding, sinks
* ``plans``      - end-to-end pipelines composed from the operators
* ``streaming``  - Structured Streaming form of the snapshot-to-daily pipeline
"""

__version__ = "0.1.0"

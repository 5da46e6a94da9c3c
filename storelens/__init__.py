"""storelens: real-time commerce analytics as Spark DataFrame / SQL / Structured Streaming jobs.

Layers (each operator is a function ``DataFrame -> DataFrame`` so batch and streaming share it):

* ``sources``   - driver tables, JSON-lines logs, stand-in adapters for the shop's records
* ``functions`` - column expressions (time, text, records)
* ``operators`` - cleaning, routing, stateful detail, joins, windowed aggregates, upsert
* ``plans``     - end-to-end jobs over the tables, and the DuckDB check SQL
* ``streaming`` - the same jobs on ``readStream`` with watermarks, state and sinks
"""

__all__ = ["session", "schemas"]

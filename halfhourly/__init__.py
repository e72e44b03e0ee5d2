"""Half-hourly energy analytics on Spark.

Everything here is a plain function from DataFrames (and explicit parameters
such as ``as_of``) to a DataFrame.  Nothing reads the wall clock, nothing
collects fact rows to the driver, and no Python UDF sits on a hot path.

Sub-packages:

* ``sources``   landed JSON payloads -> rows, strict contracts, driver-table stand-ins
* ``functions`` column expressions (half-hour bucket, share, bands, formats)
* ``operators`` natural-key merges, marts, lake maintenance, data-quality checks
* ``plans``     composite read queries and the registered query catalogue
* ``streaming`` Structured Streaming ingest (file source + foreachBatch merge)
* ``jobs``      spark-submit entry points (ingest, build, archive, expire, query)
"""

from halfhourly.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

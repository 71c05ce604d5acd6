"""strata: a layered (bronze / silver / gold) analytics library on PySpark.

Everything is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function, so it composes with ``df.transform`` and lets Catalyst plan the
whole job.

Sub-packages
------------
sources    file discovery, CSV / Parquet scans, SQL over registered views
sinks      Parquet writes with observed row counts, JDBC, byte-exact landing
functions  column expressions: periods, channel labels, ratios, formatting
operators  silver cleaning, period trends, channel performance, insights
plans      the five-step pipeline and the bindings used by the query catalog
"""

__version__ = "0.1.0"

"""weatherlake: METAR weather-observation analytics on Spark DataFrames.

Sub-packages:

- ``functions``  column expressions (unit conversion, rounding, distances)
- ``sources``    CSV ingest, stored Parquet layouts, scans, station files
- ``operators``  upserts, climatology, snapshots, nearest station, k-means
- ``plans``      the registered queries and their SQL oracles
- ``streaming``  the ingest as a Structured Streaming job
"""

__version__ = "0.1.0"

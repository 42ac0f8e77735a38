"""civitas: registry ETL on Spark.

Landed registry data (CSV, zipped CSV, paged JSON responses) becomes
DataFrames; column expressions clean and unmask it; keyed upserts fold it
into versioned Parquet tables; views and integrity audits read it back.
Everything is expressed with the public DataFrame / SQL / Structured
Streaming APIs so Catalyst plans it and the cluster scales it.
"""

__version__ = "0.1.0"

"""ledgerline: commerce ELT and pipeline analytics on Spark DataFrames.

Subpackages
-----------
sources    readers: landed API pages, the driver's tables, control tables, catalog
functions  scalar expressions (Column -> Column), no Python UDFs
operators  flatten jobs, job/log views, mutations, store config, data quality
plans      composed queries (the registry), oracle SQL, load/sink helpers, bench plans
streaming  Structured Streaming forms of the log classifier, job status and sync
"""

__version__ = "0.1.0"

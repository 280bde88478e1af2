"""basketrec — purchase-basket analytics and implicit-feedback recommendation on Spark.

Every public function takes and returns lazy ``pyspark.sql.DataFrame`` objects;
nothing leaves the cluster between ingest and evaluation.

Sub-packages
------------
sources    readers/writers (CSV, Parquet, ``|`` text, score files) and the
           adapter that derives the basket model from the TPC-H-style test tables
operators  ETL joins, co-occurrence / cosine, matrices, models, evaluation, ALS
functions  column-level helpers (seeded hash draws, array cosine, dense index)
plans      session/config helpers, size-checked broadcast, query registry, oracle SQL
"""

__version__ = "0.1.0"

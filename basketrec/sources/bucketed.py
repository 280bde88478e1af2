"""Tables bucketed and sorted by their join keys.

Two tables of equally many buckets on the same keys are joined bucket by bucket, with no shuffle of
either; neither is an aggregation on those keys shuffled.  The files lie at ``path``, by default below the
shared checkpoint folder, and the catalogue entry that holds the bucketing is dropped by ``drop``, or at
the end of a ``with`` block; dropping it leaves the files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from basketrec.session import scratch_path, shuffles_freed


class BucketedTable:
    def __init__(self, df: DataFrame, keys: list[str], buckets: int, path: str | None = None):
        self.spark, self.keys, self.buckets = df.sparkSession, keys, buckets
        self.name = f"bucketed_{uuid.uuid4().hex}"
        self.path = path or scratch_path(self.spark, "bucketed")
        # one file a bucket: each bucket is written by one task, as the join will read it
        dealt = df.repartition(buckets, *keys)
        with shuffles_freed(self.spark):
            dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def __enter__(self) -> DataFrame:
        return self.read()

    def __exit__(self, *_) -> None:
        self.drop()

"""What a stream knows of each key, as a versioned table below its checkpoint.

A batch writes the keys that it saw to `<root>/changes/batch_id=N` and reads the versions below N, so a batch that runs
again after a crash finds the same state and replaces what it wrote. Every EVERY batches all that is known goes to
`<root>/whole/batch_id=N`; a batch reads the newest whole table below it and the changes since, and those before the whole
table before that are removed. Keys that were not seen for `ttl` (in the unit of the times) go when the whole table is
written.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVERY = 16
_BATCH = "batch_id"


class KeyedState:
    def __init__(self, root: str, schema: T.StructType, keys: list[str], seen: str, ttl: int | None = None):
        """schema: keys, `seen` (the newest time of the key) and values; one row per key and version."""
        self.root, self.schema, self.keys, self.seen, self.ttl = root, schema, keys, seen, ttl

    def _folders(self, spark: SparkSession, kind: str) -> dict[int, str]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        listed = store.listStatus(path) if store.exists(path) else []
        # A folder counts once its write has ended.
        done = [f.getPath() for f in listed if store.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        return {int(re.search(r"=(\d+)$", p.getName())[1]): p.toString() for p in done}

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """One row per key: its newest version of the batches below this one."""
        return self._known(spark, batch_id, batch_id)

    def _known(self, spark: SparkSession, whole_below: int, below: int) -> DataFrame:
        whole = [n for n in self._folders(spark, "whole") if n < whole_below]
        base = max(whole, default=-1)
        changes = [p for n, p in sorted(self._folders(spark, "changes").items()) if base < n < below]
        folders = ([f"{self.root}/whole/{_BATCH}={base}"] if whole else []) + changes
        if not folders:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).parquet(*folders)
        version = F.regexp_extract("_metadata.file_path", rf"{_BATCH}=(\d+)", 1).cast("long")
        if len(folders) == 1:
            return rows
        values = [c for c in self.schema.names if c not in self.keys]
        newest = rows.withColumn("_version", version).groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_version").alias("_v"))
        return newest.select(*self.keys, "_v.*")

    def write(self, changed: DataFrame, batch_id: int) -> None:
        """The new version of the keys of a batch."""
        spark = changed.sparkSession
        changed.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/changes/{_BATCH}={batch_id}")
        if batch_id % EVERY == EVERY - 1:
            # A batch that runs again does not read the whole table that it replaces.
            every = self._known(spark, batch_id, batch_id + 1)
            if self.ttl is not None:
                newest = every.agg(F.max(self.seen)).first()[0]
                every = every if newest is None else every.where(F.col(self.seen) >= newest - self.ttl)
            every.write.mode("overwrite").parquet(f"{self.root}/whole/{_BATCH}={batch_id}")
            self._forget(spark, batch_id - EVERY)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Remove what no batch after this one reads."""
        whole = self._folders(spark, "whole")
        for kind, held in (("changes", self._folders(spark, "changes")), ("whole", whole)):
            for n, folder in held.items():
                if batch_id in whole and (n < batch_id if kind == "whole" else n <= batch_id):
                    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

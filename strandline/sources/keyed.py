"""A table by key in files, of which a batch rewrites only the buckets it touches."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyedTable:
    """Rows below one folder: bucket=B/version=N/ and CURRENT, which names the version of every bucket and the last batch.

    A batch writes new versions of the buckets its keys fall into and then replaces CURRENT by a rename (atomic where the file
    system's is): readers see all of it or nothing. A batch that was applied already changes nothing. The version before is
    kept for readers until its bucket is next written. The number of buckets is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], schema: T.StructType | str, buckets: int = 64):
        self.spark, self.root, self.key = spark, root.rstrip("/"), list(key)
        self.schema = spark.createDataFrame([], schema).schema
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self.buckets = self._current()["buckets"] or buckets

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _current(self) -> dict:
        where = self._path(f"{self.root}/CURRENT")
        if not self._fs.exists(where):
            return {"batch": -1, "buckets": None, "versions": {}}
        stream = self._fs.open(where)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _swap(self, state: dict) -> None:
        new, now = self._path(f"{self.root}/CURRENT.new"), self._path(f"{self.root}/CURRENT")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        flags = self.spark._sc._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        flags[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(now.toUri(), self._conf).rename(new, now, flags)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def _read(self, versions: dict[str, int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        own = [T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())]
        folders = [f"{self.root}/bucket={b}/version={v}" for b, v in versions.items()]
        return self.spark.read.schema(T.StructType([*self.schema.fields, *own])).option("basePath", self.root).parquet(*folders).drop("bucket", "version")

    def rows(self) -> DataFrame:
        """All rows; none while the table is empty."""
        return self._read({b: kept[0] for b, kept in self._current()["versions"].items() if kept[0] is not None})

    def _touched(self, keys: DataFrame) -> list[str]:
        return [str(r.bucket) for r in self._bucketed(keys.dropna(subset=self.key)).select("bucket").distinct().collect()]  # at most `buckets`

    def matching(self, keys: DataFrame, before: int) -> DataFrame:
        """The rows whose keys are among keys, as they were before that batch, also if it is repeated; only the buckets of those
        keys are read."""
        versions = self._current()["versions"]
        kept = {b: next((v for v in versions.get(b, []) if v is not None and v < before), None) for b in self._touched(keys)}
        return self._read({b: v for b, v in kept.items() if v is not None}).join(keys.select(*self.key).distinct(), self.key, "left_semi")

    def upsert(self, batch: DataFrame, number: int, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Bring batch in: merge gives, of old and new rows of the touched buckets together, those that stay. Rows without a key
        are left out."""
        state = self._current()
        if number <= state["batch"]:
            return
        fresh = batch.dropna(subset=self.key).select(*self.schema.names).persist()
        try:
            touched = self._touched(fresh)
            now = {b: state["versions"].get(b, [None])[0] for b in touched}
            for b in touched:
                folder = self._path(f"{self.root}/bucket={b}")
                for s in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
                    if int(s.getPath().getName().split("=")[1]) != now[b]:
                        self._fs.delete(s.getPath(), True)
            if touched:
                kept = merge(self._read({b: v for b, v in now.items() if v is not None}).unionByName(fresh)).select(*self.schema.names)
                self._bucketed(kept).withColumn("version", F.lit(number).cast("long")).repartition("bucket").write.mode("append").partitionBy("bucket", "version").parquet(self.root)
            # a bucket of which nothing stays has no folder
            written = {b: [number if self._fs.exists(self._path(f"{self.root}/bucket={b}/version={number}")) else None, now[b]] for b in touched}
            self._swap({"batch": number, "buckets": self.buckets, "versions": state["versions"] | written})
        finally:
            fresh.unpersist()

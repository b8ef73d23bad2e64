"""A table that streams upsert: versions that appear whole.

The table's rows lie in buckets by key. A version is a manifest, one small file that names the
folder of every bucket; it is written under another name and renamed, so it is there whole or not at
all. A batch reads the buckets it touches from the last version, merges, writes them to new
folders and then adds the next version; other buckets keep their folders. So

* a reader sees one version from start to end, whatever is written meanwhile;
* a batch that dies before its manifest leaves folders that no version names;
* a batch that is run again after its manifest is there changes nothing (versions carry the
  batch id), and one that is run again before starts from the version that it started from.

Versions stay until ``vacuum`` removes the ones before the last few.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    # files go through the file system that Spark itself uses for the path

    def _file(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._file("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers (batch ids) of the versions, oldest first."""
        fs, home = self._fs(), self._file("versions")
        names = [f.getPath().getName() for f in fs.listStatus(home)] if fs.exists(home) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int) -> dict:
        """{"schema": ..., "buckets": {bucket: folder}} of a version."""
        stream = self._fs().open(self._file(f"versions/{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        fs = self._fs()
        part, whole = self._file(f"versions/.{uuid.uuid4().hex}"), self._file(f"versions/{version:012d}.json")
        out = fs.create(part)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not fs.rename(part, whole):
            raise RuntimeError(f"version {version} of {self.path} could not be added")

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table at its last (or the given) version; None before the first."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return self._rows(self.manifest(version), None)

    def _rows(self, manifest: dict, buckets: list[int] | None) -> DataFrame:
        folders = [f"{self.path}/{f}" for b, f in manifest["buckets"].items() if buckets is None or int(b) in buckets]
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def upsert(self, batch: DataFrame, batch_id: int, combine=None) -> None:
        """Merge a batch (``foreachBatch``). Its rows replace those of equal keys or, with
        ``combine``, are aggregated with them by ``combine(rows)``."""
        known = self.versions()
        if known and known[-1] >= batch_id:        # run again: it is in
            return
        last = self.manifest(known[-1]) if known else {"buckets": {}}
        new = combine(batch) if combine else batch
        names = new.columns
        home = f"data/{batch_id:012d}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        staged = f"{self.path}/{home}/batch"
        new.withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(staged)
        new = self.spark.read.parquet(staged) if self._any(f"{home}/batch") else None
        if new is None:                            # nothing in the batch
            self._commit(batch_id, {**last, "schema": last.get("schema") or json.loads(batch.limit(0).schema.json() if combine is None else combine(batch.limit(0)).schema.json())})
            return
        touched = [r[0] for r in new.select("_bucket").distinct().collect()]     # ``buckets`` at most
        rows = new.select(*names)
        if any(str(b) in last["buckets"] for b in touched):
            old = self._rows(last, touched)
            rows = combine(old.unionByName(rows)) if combine else old.join(rows.select(*self.keys), self.keys, "left_anti").select(*names).unionByName(rows)
        rows.withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(f"{self.path}/{home}/rows")
        folders = {**last["buckets"], **{str(b): f"{home}/rows/_bucket={b}" for b in touched}}
        self._commit(batch_id, {"schema": json.loads(rows.schema.json()), "buckets": folders})

    def _any(self, folder: str) -> bool:
        return any(f.isDirectory() for f in self._fs().listStatus(self._file(folder)))

    def vacuum(self, keep: int = 10) -> None:
        """Remove all versions but the last ``keep`` and the folders that none of those names.
        Readers of an older version must have ended."""
        known, fs = self.versions(), self._fs()
        named = {f.split("/")[1] for v in known[-keep:] for f in self.manifest(v)["buckets"].values()}
        for v in known[:-keep]:
            fs.delete(self._file(f"versions/{v:012d}.json"), False)
        for f in fs.listStatus(self._file("data")):
            name = f.getPath().getName()
            if name not in named and known and int(name.split("-")[0]) <= known[-1]:
                fs.delete(f.getPath(), True)

"""A target whose versions are manifests: a batch is visible as a whole or not at all, and once, however often it is tried."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer made the version that this one was about to make."""


class VersionedTarget:
    """Rows in Parquet files by bucket of their key, below path in any store that Spark writes to.

    Version n is the file _versions/n.json: the folder of each bucket, and for each writer the last of its batches that
    the version has. A batch writes the buckets it touches to a folder of its own and then makes the next version, by a
    rename that fails if the version is there already. So a batch that fails half-way leaves a folder that no version
    knows (vacuum() deletes those), and one that is tried again is skipped by the ledger. Readers see the version that
    they began with.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], buckets: int = 16):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, list(key), buckets
        jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.path).getFileSystem(self._conf)
        self._store.mkdirs(self._path(f"{self.path}/_versions"))

    def version(self) -> int:
        """The latest version, 0 before the first."""
        names = [x.getPath().getName() for x in self._store.listStatus(self._path(f"{self.path}/_versions"))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"folders": {}, "ledger": {}}
        stream = self._store.open(self._path(f"{self.path}/_versions/{version}.json"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _publish(self, version: int, manifest: dict) -> None:
        draft, final = self._path(f"{self.path}/_versions/.{uuid.uuid4().hex}"), self._path(f"{self.path}/_versions/{version}.json")
        out = self._store.create(draft)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._store.getUri(), self._conf).rename(draft, final, gateway.new_array(kind, 0))
        except Exception as e:
            self._store.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version} of {self.path} is there already") from e
            raise

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, by default the latest."""
        return self._rows(sorted(self.manifest(version)["folders"].values()))

    def apply(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], writer: str, batch_id: int, attempts: int = 3) -> bool:
        """Makes a version of what change(rows, batch) returns for the rows of the buckets that the batch's keys are in.

        False if the target has the writer's batch_id, or a later one, already. Where another writer was faster, the
        change is made again on what that one left, up to attempts times.
        """
        for attempt in range(attempts):
            version = self.version()
            now = self.manifest(version)
            if now["ledger"].get(writer, -1) >= batch_id:
                return False
            touched = sorted(r.b for r in batch.select(self._bucket().alias("b")).distinct().collect())  # no more than there are buckets
            old = self._rows([now["folders"][str(b)] for b in touched if str(b) in now["folders"]])
            folder = f"data-{uuid.uuid4().hex}"
            names = [f.split()[0] for f in self.schema.split(", ")]
            change(old, batch).select(*names, self._bucket().alias("_bucket")).repartition(F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            made = {x.getPath().getName().partition("=")[2] for x in self._store.listStatus(self._path(f"{self.path}/{folder}")) if x.getPath().getName().startswith("_bucket=")}
            stray = made - set(map(str, touched))
            if stray:
                raise ValueError(f"change() returned rows of keys that aren't in buckets of the batch: {sorted(stray)[:5]}")
            kept = {b: f for b, f in now["folders"].items() if int(b) not in touched}
            try:
                self._publish(version + 1, {"folders": kept | {b: f"{folder}/_bucket={b}" for b in made}, "ledger": now["ledger"] | {writer: batch_id}})
                return True
            except Conflict:
                if attempt == attempts - 1:
                    raise
        return False

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes all but the last `keep` versions, and data folders that none of those has (also of batches that failed; none may be running)."""
        last = self.version()
        for v in range(1, last - keep + 1):
            self._store.delete(self._path(f"{self.path}/_versions/{v}.json"), False)
        used = {f.partition("/")[0] for v in range(max(1, last - keep + 1), last + 1) for f in self.manifest(v)["folders"].values()}
        gone = [n for x in self._store.listStatus(self._path(self.path)) if (n := x.getPath().getName()).startswith("data-") and n not in used]
        for n in gone:
            self._store.delete(self._path(f"{self.path}/{n}"), True)
        return sorted(gone)

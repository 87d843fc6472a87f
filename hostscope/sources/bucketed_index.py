"""A table in key buckets under numbered manifests: an upsert rewrites the buckets it touches and commits in one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
_BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer committed first."""


class BucketedIndex:
    """Rows by hash buckets of their keys. A manifest names each bucket's folder; the greatest manifest is the table.

    Files are never changed. A commit creates the next manifest, which fails if it is there already, so of two writers
    that read the same version one commits and the other one starts again. A writer that is lost before its commit
    leaves folders that no manifest names. Manifests are as long as the number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, list(keys), buckets
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._no_file = (jvm.org.apache.hadoop.fs.FileAlreadyExistsException, jvm.java.io.FileNotFoundException)

    def version(self) -> int:
        """The number of the last commit; 0 for a table that nothing was written to."""
        folder = self._path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        version = self.version() if version is None else version
        if not version:
            return {}
        raw = self.spark.read.text(f"{self.path}/manifests/{version:012d}.json", wholetext=True).first()[0]
        return {int(k): v for k, v in json.loads(raw).items()}

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (the last one), of some buckets if asked for."""
        held = self.manifest(version)
        folders = [f"{self.path}/{v}" for k, v in held.items() if only is None or k in only]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _commit(self, version: int, manifest: dict[int, str]) -> None:
        from py4j.protocol import Py4JJavaError

        at = self._path(f"{self.path}/manifests/{version:012d}.json")
        sent = self._path(f"{self.path}/manifests/_{uuid.uuid4().hex}")
        out = self._fs.create(sent, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        try:
            # whole before it has its name; a file that is there already is not replaced
            done = not self._fs.exists(at) and self._fs.rename(sent, at) and json.dumps(self.manifest(version)) == json.dumps({int(k): v for k, v in manifest.items()})
        except Py4JJavaError:
            done = False
        if not done:
            self._fs.delete(sent, False)
            raise Conflict(f"version {version} of {self.path} was committed by another writer")

    def bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def upsert(self, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], tries: int = 5, before_commit: Callable[[], None] | None = None) -> list[int]:
        """Merges new rows in and returns the buckets that were rewritten; after a conflict it starts from the new version.

        merge(old, new) gets the rows of the touched buckets only and has to keep keys as they are. before_commit runs
        between writing and committing (for tests).
        """
        from hostscope.sources.scratch import written

        rows = written(self.bucket(new), "index-rows")
        touched = sorted(r[0] for r in rows.select(_BUCKET).distinct().collect())
        for _ in range(tries):
            if not touched:
                return []
            version = self.version()
            held = self.manifest(version)
            merged = merge(self.read(version, touched), rows.drop(_BUCKET)).select(*[f.name for f in self.schema])
            folder = f"data/{uuid.uuid4().hex}"
            self.bucket(merged).repartition(F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
            if before_commit:
                before_commit()
            try:
                self._commit(version + 1, held | {k: f"{folder}/{_BUCKET}={k}" for k in touched})
                return touched
            except Conflict:
                continue
        raise Conflict(f"{tries} tries to write {self.path} met other writers")

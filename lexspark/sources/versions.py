"""Several tables that change together: each version of the set is one manifest.

Data is written beside what there is, in a folder of its own; a version becomes visible when its
manifest, one small file whose name is the version's number, is renamed into place, which fails if
another has that number. So whatever a job leaves behind when it fails, before or between tables,
readers see the tables of one version, and of two writers that start from one version one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class VersionConflict(RuntimeError):
    """Another writer has made this version."""


class TableSet:
    """Named tables under a shared folder. Versions count from 1; there is none before the first commit."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_versions/{version:08d}.json"

    def version(self) -> int:
        """The number of the last version, 0 if there is none."""
        at = self._path(f"{self.root}/_versions")
        if not self._fs.exists(at):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return max((int(n[:8]) for n in names if n[:8].isdigit() and n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "tables": {}}
        (text,) = [r.value for r in self.spark.read.text(self._manifest(version), wholetext=True).collect()]
        return json.loads(text)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.manifest(version)["tables"][name])

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        return {name: self.spark.read.parquet(at) for name, at in self.manifest(version)["tables"].items()}

    def stage(self, tables: Mapping[str, DataFrame]) -> dict[str, str]:
        """Writes tables where no reader looks; their folders, for commit."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        out = {}
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}")
            out[name] = f"{folder}/{name}"
        return out

    def commit(self, staged: Mapping[str, str], base: int, **notes) -> int:
        """Makes version base + 1 of what was staged and, for other tables, of version base."""
        content = {"version": base + 1, "tables": self.manifest(base)["tables"] | dict(staged), **notes}
        target = self._path(self._manifest(base + 1))
        draft = self._path(f"{self.root}/_versions/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(json.dumps(content, sort_keys=True).encode())
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(target), never)
        except Exception as error:
            self._fs.delete(draft, False)
            if self._fs.exists(target):
                raise VersionConflict(f"version {base + 1} of {self.root} is there already") from error
            raise
        return base + 1

    def write(self, tables: Mapping[str, DataFrame], base: int | None = None, **notes) -> int:
        base = self.version() if base is None else base
        return self.commit(self.stage(tables), base, **notes)

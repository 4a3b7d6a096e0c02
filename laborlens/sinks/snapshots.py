"""Versioned tables (K3, K10): data folders and a commit file per version.

A version's data is written to a folder of its own; then one small commit file
that lists all folders of the table is moved into place. The newest commit is
the table: a reader never meets a half-written version, a failed or repeated
job leaves at most a folder that no commit names, and older versions can still
be read until ``vacuum``. Folders may differ in their columns: they are merged
by name, and a column that a folder lacks reads as null.

Several folders per version make a log-structured table: a small change adds a
small folder (level 0), ``fanout`` folders of a level are merged into one of the
next (``compact``), so what is written follows the change and what is read
stays a few folders per level.

Versions are names that sort in commit order. Committing a version again
replaces that commit (from the same base, so a repeated batch changes nothing).
One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._cls(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ commits

    def versions(self) -> list[str]:
        """Committed versions, oldest first."""
        root = self._cls(f"{self.path}/_commits")
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(n[:-len(".json")] for n in names if n.endswith(".json"))

    def folders(self, version: str | None = None, before: str | None = None) -> list[dict]:
        """The folders (name, level, schema) of a version: the given one, or the newest (``before``: older than that)."""
        found = [v for v in self.versions() if (version is None or v == version) and (before is None or v < before)]
        if not found:
            if version is not None:
                raise ValueError(f"{self.path} has no version {version}")
            return []
        text = self.spark.read.text(f"{self.path}/_commits/{found[-1]}.json", wholetext=True).first()[0]
        return json.loads(text)["folders"]

    def _publish(self, version: str, folders: list[dict]) -> None:
        commits = self._cls(f"{self.path}/_commits")
        self._fs.mkdirs(commits)
        draft, final = self._cls(f"{self.path}/_commits/.{version}.draft"), self._cls(f"{self.path}/_commits/{version}.json")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps({"folders": folders}).encode("utf-8")))
        out.close()
        if self._fs.exists(final):
            self._fs.delete(final, False)
        if not self._fs.rename(draft, final):
            raise OSError(f"cannot move {draft.toString()} into place")

    def _write(self, df: DataFrame, name: str, level: int) -> dict:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return {"name": name, "level": level, "schema": df.schema.json()}

    # ------------------------------------------------------------ writing

    def overwrite(self, df: DataFrame, version: str) -> None:
        """K3: ``df`` is the table from this version on."""
        self._publish(version, [self._write(df, f"data-{version}", 0)])

    def append(self, df: DataFrame, version: str) -> None:
        """The table of the versions before, and ``df``."""
        self._publish(version, [*self.folders(before=version), self._write(df, f"data-{version}", 0)])

    def upsert(self, change: DataFrame, version: str, merge: Callable[[DataFrame], DataFrame], fanout: int = 4) -> None:
        """Log-structured change: adds ``change`` as a folder and merges full levels by
        ``merge`` (which takes the rows of several folders to the rows that stand for them)."""
        live = [*self.folders(before=version), self._write(merge(change), f"data-{version}", 0)]
        level = 0
        while sum(f["level"] == level for f in live) >= fanout:
            full = [f for f in live if f["level"] == level]
            one = self._write(merge(self._read(full)), f"data-{version}-level{level + 1}", level + 1)
            live = [f for f in live if f["level"] != level] + [one]
            level += 1
        self._publish(version, live)

    # ------------------------------------------------------------ reading

    def _read(self, folders: list[dict]) -> DataFrame:
        parts = [self.spark.read.schema(T.StructType.fromJson(json.loads(f["schema"]))).parquet(f"{self.path}/{f['name']}")
                 for f in folders]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def read(self, version: str | None = None, before: str | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The rows of a version's folders; ``schema`` is that of an empty table."""
        folders = self.folders(version, before)
        if folders:
            return self._read(folders)
        if schema is None:
            raise ValueError(f"{self.path} has no version yet")
        return self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove commits but the ``keep`` newest, and the data folders that none of these names."""
        versions = self.versions()
        stay = {f["name"] for v in versions[-keep:] for f in self.folders(v)}
        for v in versions[:-keep]:
            self._fs.delete(self._cls(f"{self.path}/_commits/{v}.json"), False)
        gone = [s.getPath().getName() for s in self._fs.listStatus(self._cls(self.path))
                if s.getPath().getName().startswith("data-") and s.getPath().getName() not in stay]
        for name in gone:
            self._fs.delete(self._cls(f"{self.path}/{name}"), True)
        return sorted(gone)

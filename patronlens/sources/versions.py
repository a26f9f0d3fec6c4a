"""Versions of a stored table.

A table is a set of parts (a period, or a range of hashed keys), each a folder of Parquet
files. A version is a small manifest that names the folder of every part. Writers put new
parts into new folders and then publish a manifest with the next number by one rename, so a
reader sees the version before or the one after, never a mixture, and a writer that stops
anywhere leaves the table as it was. Parts that did not change keep their folders.

Two writers that start from the same version cannot both publish: the second one fails.
Folders are deleted when neither the current manifest nor the one before it names them, so
a query that began on the version before can still finish. The rename must be atomic, as it
is on HDFS and local disks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

_NONE = {"number": 0, "parts": {}}


class Versions:
    def __init__(self, spark: SparkSession, root: str, part: str, kind: T.DataType):
        """`part` names the column whose values are the parts."""
        self.spark, self.root, self.part, self.kind = spark, root, part, kind
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *names)))

    def _names(self, *folder: str) -> list[str]:
        path = self._path(*folder)
        files = path.getFileSystem(self._conf)
        return ([s.getPath().getName() for s in files.listStatus(path)]
                if files.exists(path) else [])

    def _numbers(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names("versions")
                      if n.startswith("v") and n.endswith(".json"))

    def _manifest(self, number: int) -> dict:
        path = self._path("versions", f"v{number:012d}.json")
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> dict:
        """The published version: its number, the folder of each part, and notes."""
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else dict(_NONE)

    def read(self, version: dict, schema: T.StructType,
             parts: Iterable[str] | None = None) -> DataFrame:
        """The table, or some of its parts; filters on the part column skip folders."""
        chosen = version["parts"] if parts is None else {
            p: version["parts"][p] for p in parts if p in version["parts"]}
        if not chosen:
            return self.spark.createDataFrame([], schema)
        fields = [f for f in schema.fields if f.name != self.part]
        stored = T.StructType([*fields, T.StructField("_v", T.StringType()),
                               T.StructField(self.part, self.kind)])
        paths = [f"{self.root}/data/{folder}" for folder in chosen.values()]
        return (self.spark.read.schema(stored).option("basePath", f"{self.root}/data")
                .parquet(*paths).select(*schema.names))

    def write(self, df: DataFrame, options: dict[str, str] | None = None) -> dict[str, str]:
        """Write the parts that `df` has rows for into new folders, not yet published."""
        fresh = f"_v={uuid.uuid4().hex}"
        df.write.options(**(options or {})).partitionBy(self.part).parquet(
            f"{self.root}/data/{fresh}")
        begin = f"{self.part}="
        return {name[len(begin):]: f"{fresh}/{name}" for name in self._names("data", fresh)
                if name.startswith(begin)}

    def publish(self, before: dict, parts: dict[str, str], **notes) -> dict:
        """Make `parts` the table, if `before` is still its current version."""
        after = {"number": before["number"] + 1, "parts": parts,
                 **{k: v for k, v in before.items() if k not in ("number", "parts")}, **notes}
        draft = self._path("versions", f"draft-{uuid.uuid4().hex}")
        files = draft.getFileSystem(self._conf)
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(after).encode()))
        finally:
            stream.close()
        target = self._path("versions", f"v{after['number']:012d}.json")
        self._rename(draft, target)
        self._forget_before(before)
        return after

    def _rename(self, draft, target) -> None:
        """Fails where `target` exists, unlike a rename of files on a local disk."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf) \
            if draft.toUri().getScheme() else self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        context.rename(draft, target, none)

    def _forget_before(self, kept: dict) -> None:
        """Delete older manifests and the folders that only they name."""
        old = [n for n in self._numbers() if n < kept["number"]]
        now = self.current()
        named = {*kept["parts"].values(), *now["parts"].values()}
        files = self._path().getFileSystem(self._conf)
        for number in old:
            for folder in set(self._manifest(number)["parts"].values()) - named:
                files.delete(self._path("data", folder), True)
            files.delete(self._path("versions", f"v{number:012d}.json"), False)

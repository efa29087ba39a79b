"""Tables in versions: data is written to a place of its own, and one pointer, put only where none is yet, makes it the version.

A folder holds `published/<number>`, one small JSON file a version, and `data/`. A pointer names what the version changes of each
table: the whole table, or a delta (rows with op insert, update or delete, at most one a key). Whatever a reader has
opened stays as it is; several tables of one version appear at once; of two writers on one version the second one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FULL, DELTA = "full", "delta"


class Conflict(RuntimeError):
    """Another writer has published on the same version."""


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _pointer(self, number: int) -> dict | None:
        """What a version says; None where its pointer is not (wholly) there."""
        path, files = self._path("published", f"{number:010d}")
        if not files.exists(path):
            return None
        text = "".join(r[0] for r in self.spark.read.text(path.toString()).collect())
        return json.loads(text) if text.endswith("}") else None

    def latest(self) -> int:
        """The number of the newest version; 0 where there is none."""
        path, files = self._path("published")
        if not files.exists(path):
            return 0
        numbers = sorted((int(s.getPath().getName()) for s in files.listStatus(path)), reverse=True)
        return next((n for n in numbers if self._pointer(n) is not None), 0)

    def facts(self, number: int) -> dict:
        """What was noted beside the tables of a version."""
        return self._known(number)["facts"]

    def _known(self, number: int) -> dict:
        pointer = self._pointer(number)
        if pointer is None:
            raise ValueError(f"there is no version {number}")
        return pointer

    def commit(self, on: int, tables: dict[str, DataFrame], deltas: Iterable[str] = (), facts: dict | None = None) -> int:
        """Publish tables as the version after `on`; those named in deltas change the table, the others are it. Tables that are not named stay.

        Raises Conflict, and takes its data back, where that version is there already.
        """
        said, places = {}, []
        for name, df in tables.items():
            place = f"{name}-{uuid.uuid4().hex}"
            places.append(place)
            df.write.parquet(f"{self.folder}/data/{place}")
            said[name] = {"data": place, "kind": DELTA if name in set(deltas) else FULL, "schema": json.loads(df.schema.json())}
        path, files = self._path("published", f"{on + 1:010d}")
        try:
            if files.exists(path) or on != self.latest():
                raise Conflict(f"version {on + 1} of {self.folder} is there already")
            try:
                out = files.create(path, False)
            except Exception as error:
                if files.exists(path):
                    raise Conflict(f"version {on + 1} of {self.folder} is there already") from error
                raise
            out.write(json.dumps({"tables": said, "facts": facts or {}}).encode())
            out.close()
        except Conflict:
            for place in places:
                data, files = self._path("data", place)
                files.delete(data, True)
            raise
        return on + 1

    def table(self, name: str, version: int | None = None, keys: list[str] | None = None) -> DataFrame:
        """A table as a version has it: its last whole state, and over that the last delta of each key."""
        version = self.latest() if version is None else version
        changes = []
        for number in range(version, 0, -1):
            said = self._known(number)["tables"].get(name)
            if said is None:
                continue
            read = self.spark.read.schema(T.StructType.fromJson(said["schema"])).parquet(f"{self.folder}/data/{said['data']}")
            if said["kind"] == FULL:
                return after_deltas(read, changes, keys) if changes else read
            changes.append((number, read))
        raise ValueError(f"version {version} of {self.folder} has no {name}")

    def compact(self, name: str, keys: list[str]) -> int:
        """Publish the newest state of a table as a whole one."""
        on = self.latest()
        return self.commit(on, {name: self.table(name, on, keys)}, facts=self.facts(on))


def after_deltas(base: DataFrame, changes: list[tuple[int, DataFrame]], keys: list[str]) -> DataFrame:
    """base after numbered deltas: the newest row of each key counts. The base meets the changed keys in one anti join, which broadcasts few."""
    columns = base.columns
    every = None
    for number, delta in changes:
        own = delta.select("op", *columns).withColumn("_number", F.lit(number))
        every = own if every is None else every.unionByName(own)
    last = every.groupBy(*keys).agg(F.max_by(F.struct("op", *[c for c in columns if c not in keys]), "_number").alias("_last"))
    written = last.where("_last.op <> 'delete'").select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in columns])
    return base.join(last.select(*keys), keys, "left_anti").select(*columns).unionByName(written)

"""Change windows as a data source (T1, X1): landed pages of edits, read by layer and generation, whole or as a stream that goes on where it was.

Pages lie in `<folder>/layer=<id>/generation=<n>/<page>.json`, lines of JSON. A generation of a layer is landed once its folder has a file
`_done`, and is not changed after that. A stream's offset is the last generation read of each layer, which is the cursor of an incremental run:
its checkpoint keeps it, and the window behind it is what the next batch reads. Pages are packed into partitions by their bytes.

    register(spark)
    spark.readStream.format("change_windows").schema(...).load(folder)
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition
from pyspark.sql.types import LongType, StructType

#: Columns that come from a page's place.
PLACE = ("layer", "generation")
#: Bytes of pages in a partition, and what opening a page counts besides.
PACKED, OPENING = 32 << 20, 256 << 10
#: Windows that a task writes (about), and folders listed at once.
WRITTEN, LISTED = 64, 16


def register(spark: SparkSession) -> None:
    """Make `change_windows` known to a session, and let it choose pages by conditions."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WindowSource)


def land(edits: DataFrame, folder: str) -> None:
    """Write edits (layer, generation, ...) as pages of windows: the pages by Spark's committer, then the marks that say a generation is done."""
    windows = edits.select("layer", "generation").distinct()
    tasks = max(1, -(-windows.count() // WRITTEN))  # windows are small and many: their number says how many tasks write them, not their bytes
    edits.repartition(tasks, "layer", "generation").write.mode("append").partitionBy("layer", "generation").json(folder)

    def mark(rows):
        place = Windows(folder)
        for row in rows:
            place.mark(row["layer"], row["generation"])

    windows.repartition(tasks, "layer", "generation").foreachPartition(mark)


class Pages(InputPartition):
    """Pages that a task reads: path, layer and generation of each."""

    def __init__(self, pages: list[tuple[str, int, int]]):
        self.pages = pages


def packed(pages: list[tuple[str, int, int, int]]) -> list[Pages]:
    """Partitions of pages (path, layer, generation, bytes), in order: a partition ends before the page that would bring it over PACKED."""
    out, own, total = [], [], 0
    for *page, size in pages:
        if own and total + size + OPENING > PACKED:
            out.append(Pages(own))
            own, total = [], 0
        own.append(tuple(page))
        total += size + OPENING
    return [*out, Pages(own)] if own else out


class Windows:
    """What is landed in a folder of any file system that Arrow can open."""

    def __init__(self, folder: str):
        self.files, self.root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)

    def _numbered(self, path: str, word: str) -> dict[int, str]:
        found = self.files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return {int(f.base_name.partition("=")[2]): f.path for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(f"{word}=")}

    def mark(self, layer: int, generation: int) -> None:
        """Say that a generation of a layer is done."""
        self.files.open_output_stream(f"{self.root}/layer={layer}/generation={generation}/_done").close()

    def landed(self, chosen=lambda layer, generation: True) -> dict[tuple[int, int], list[tuple[str, int, int, int]]]:
        """(layer, generation) and pages (path, layer, generation, bytes) of the chosen generations that are done; each folder is listed once."""
        places = [(layer, generation, inner) for layer, path in self._numbered(self.root, "layer").items() for generation, inner in self._numbered(path, "generation").items() if chosen(layer, generation)]
        with ThreadPoolExecutor(LISTED) as pool:
            found = list(pool.map(lambda place: self.files.get_file_info(fs.FileSelector(place[2])), places))
        done = [any(f.base_name == "_done" and f.type == fs.FileType.File for f in inside) for inside in found]
        pages = [[(f.path, layer, generation, f.size or 0) for f in sorted(inside, key=lambda f: f.path) if f.base_name.endswith(".json")] for (layer, generation, _), inside in zip(places, found)]
        return {place[:2]: own for place, own, ok in zip(places, pages, done) if ok}

    def rows(self, part: Pages | None, schema: StructType) -> Iterator[tuple]:
        """The rows of a partition's pages; Spark reads None where there are no pages."""
        for path, layer, generation in part.pages if part else []:
            with self.files.open_input_stream(path) as stream:
                for line in stream.read().decode().splitlines():
                    if line.strip():
                        row = json.loads(line) | {"layer": layer, "generation": generation}
                        yield tuple(row.get(f.name) for f in schema)


class WindowReader(DataSourceReader):
    """All landed windows; conditions on layer and generation choose the pages, the others stay with Spark."""

    def __init__(self, folder: str, schema: StructType):
        self.folder, self.schema = folder, schema
        self.layers: set[int] | None = None
        self.least = 0
        self.only: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column == "layer" and isinstance(f, EqualTo | In):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.layers = own if self.layers is None else self.layers & own
            elif column == "generation" and isinstance(f, EqualTo):
                self.only = {f.value} if self.only is None else self.only & {f.value}
            elif column == "generation" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.least = max(self.least, f.value + isinstance(f, GreaterThan))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        wanted = lambda layer, generation: (self.layers is None or layer in self.layers) and generation >= self.least and (self.only is None or generation in self.only)
        return packed([page for _, pages in sorted(Windows(self.folder).landed(wanted).items()) for page in pages])

    def read(self, partition: Pages) -> Iterator[tuple]:
        return Windows(self.folder).rows(partition, self.schema)


class WindowStream(DataSourceStreamReader):
    """Windows as they land: an offset is the last generation of each layer."""

    def __init__(self, folder: str, schema: StructType, since: dict):
        self.folder, self.schema, self.since = folder, schema, since

    def initialOffset(self) -> dict:
        return dict(self.since)

    def latestOffset(self) -> dict:
        last = dict(self.since)
        later = lambda layer, generation: generation > last.get(str(layer), -1)
        for layer, generation in sorted(Windows(self.folder).landed(later)):
            last[str(layer)] = max(generation, last.get(str(layer), -1))
        return last

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        between = lambda layer, generation: start.get(str(layer), -1) < generation <= end.get(str(layer), -1)
        return packed([page for _, pages in sorted(Windows(self.folder).landed(between).items()) for page in pages])

    def read(self, partition: Pages) -> Iterator[tuple]:
        return Windows(self.folder).rows(partition, self.schema)

    def commit(self, end: dict) -> None:
        pass


class WindowSource(DataSource):
    """`change_windows`: give a schema; layer and generation are filled from a page's place. Option since: a cursor, {"layer": generation} as JSON, behind which a stream that starts anew begins."""

    @classmethod
    def name(cls) -> str:
        return "change_windows"

    def schema(self) -> StructType:
        return StructType().add("layer", LongType()).add("generation", LongType())

    def _folder(self) -> str:
        if not self.options.get("path"):
            raise ValueError("change_windows needs a folder to load")
        return self.options["path"].rstrip("/")

    def reader(self, schema: StructType) -> DataSourceReader:
        return WindowReader(self._folder(), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return WindowStream(self._folder(), schema, json.loads(self.options.get("since", "{}")))

"""Operation logs, manifests, indexes, cursors and reports: reading them strictly, writing them once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import safe_name, table_cell

OPERATION = "type string, dataset string, feature_id string, geometry_wkb_hex string, properties variant, native_geometry_wkb_hex string, native_srid int, native_crs_wkt string"
ATTACHMENT_OPERATION = "op string, feature_id string, name string, global_id string, content_type string, size bigint, file string, metadata variant"
INDEX = "oid string, feature_id string, hash bigint"
ATTACHMENT_INDEX = "global_id string, feature_id string, name string, oid bigint, size bigint, content_type string"
CURSOR = "service string, dataset string, layer bigint, generation bigint"

#: Operation tags that a log may hold.
OPERATIONS = ("insert", "update", "delete")
ATTACHMENT_OPERATIONS = ("add", "update", "delete")


def checked_tag(tag, allowed: tuple[str, ...]):
    """The tag, or an error for one that is missing or unknown: the tag decides, not the fields that are there."""
    message = F.concat(F.lit("unknown operation "), F.coalesce(tag, F.lit("(none)")))
    return F.when(tag.isin(*allowed), tag).otherwise(F.raise_error(message).cast("string"))


def parse_operations(lines: DataFrame, body: str = "value") -> DataFrame:
    """Operations from JSON lines (S9). A delete carries no state, whatever fields it has; an absent original means none."""
    op = lines.select(F.from_json(body, OPERATION).alias("o")).select("o.*")
    state = ["geometry_wkb_hex", "properties", "native_geometry_wkb_hex", "native_srid", "native_crs_wkt"]
    return op.withColumn("type", checked_tag(F.col("type"), OPERATIONS)).withColumns({c: F.when(F.col("type") != "delete", F.col(c)) for c in state})


def parse_attachment_operations(lines: DataFrame, body: str = "value") -> DataFrame:
    """Attachment operations from JSON lines (S10); a missing tag means add."""
    op = lines.select(F.from_json(body, ATTACHMENT_OPERATION).alias("o")).select("o.*")
    return op.withColumn("op", checked_tag(F.coalesce("op", F.lit("add")), ATTACHMENT_OPERATIONS))


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The one row of a manifest (S11); sections that are absent are empty, a missing schema is an error."""
    row = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("m")).select(F.to_json("m").alias("text")).first()
    if row is None or row["text"] is None:
        raise ValueError("not a manifest")
    import json

    manifest = {"incremental": False, "datasets": [], "relationships": [], "attachments": [], "log": []} | json.loads(row["text"])
    for dataset in manifest["datasets"]:
        if "schema" not in dataset:
            raise ValueError(f"dataset {dataset.get('name')} has no schema")
    return manifest


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A key index written as JSON lines (S12); blank lines are passed over, a line that is no entry is an error when read, a missing file at once."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    entry = F.from_json("value", INDEX)
    good = entry["oid"].isNotNull() & entry["feature_id"].isNotNull()
    bad = F.raise_error(F.concat(F.lit("not an index entry: "), F.left("value", F.lit(80)))).cast(T._parse_datatype_string(INDEX))
    return lines.select(F.when(good, entry).otherwise(bad).alias("e")).select("e.*")


def bad_index_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1) and value of the lines of an index that are no entries (S12), blank ones aside."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    entry = F.from_json("value", INDEX)
    bad = (F.trim("value") != "") & (entry["oid"].isNull() | entry["feature_id"].isNull())
    # lines before each block of a file, then the place in the block: no file goes through one task
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    known = blocks.select("file", "block", "first", before.alias("before"))
    return lines.where(bad).join(known, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "value")


def read_attachment_index(spark: SparkSession, path: str) -> DataFrame:
    """An attachment index (S13); where there is none it is empty."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file):
        return spark.createDataFrame([], ATTACHMENT_INDEX)
    return spark.read.schema(ATTACHMENT_INDEX).json(path)


def write_operations(ops: DataFrame, path: str) -> None:
    """An operation log as JSON lines in a folder per dataset (K1)."""
    ops.repartition("dataset", F.pmod(F.xxhash64("feature_id"), F.lit(16))).write.partitionBy("dataset").json(path)


def write_index(index: DataFrame, table: str, path: str, buckets: int = 64) -> DataFrame:
    """A key index (dataset, key, ...) as a table at a path, bucketed by dataset and key (K3), read back: a later run joins it without moving it.

    Entries of a bucket are sorted and lie in one file where they come from one task, which is why they are dealt out first.
    """
    keys = ["dataset", "key"]
    index.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).mode("overwrite").saveAsTable(table)
    return index.sparkSession.table(table)


def next_cursor(previous: DataFrame, window: DataFrame, mode: str) -> DataFrame:
    """The cursor after a run (K4, T1): full reads and feeds record the generation they ended at, local diffs none.

    previous and window: service, dataset, layer, generation. Layers that the run did not meet keep their entry.
    """
    if mode == "local":
        return previous.limit(0)
    keys = ["service", "dataset", "layer"]
    return window.where("generation is not null").unionByName(previous.join(window, keys, "left_anti"))


def manifest_row(datasets: DataFrame, relationships: DataFrame, log: DataFrame, source: str, incremental: bool) -> DataFrame:
    """One row of JSON from the plan tables (K2). Plans have a row per dataset, class or item, so they fit one row."""
    gather = lambda df, order: df.agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in df.columns if c != order]))).alias("rows"))
    one = gather(datasets, "name").withColumnRenamed("rows", "datasets").crossJoin(gather(relationships, "name").withColumnRenamed("rows", "relationships")).crossJoin(gather(log, "seq").withColumnRenamed("rows", "log"))
    return one.select(F.to_json(F.struct(F.lit(source).alias("source"), F.lit(incremental).alias("incremental"), "datasets", "relationships", "log")).alias("value"))


def blob_paths(blobs: DataFrame) -> DataFrame:
    """blobs with file, dataset/number-name (K5, W5): numbers count from 0 in each dataset, in order of feature and name."""
    nth = F.row_number().over(Window.partitionBy("dataset").orderBy("feature_id", "name")) - 1
    return blobs.withColumn("file", F.concat_ws("/", safe_name(F.col("dataset")), F.concat_ws("-", nth.cast("string"), safe_name(F.col("name")))))


def write_blobs(blobs: DataFrame, path: str) -> DataFrame:
    """The bytes of blobs (dataset, feature_id, name, payload) under their file names (K5), as a table of file and payload, read back."""
    blob_paths(blobs).select("file", "payload").write.parquet(path)
    return blobs.sparkSession.read.parquet(path)


def report_documents(items: DataFrame) -> DataFrame:
    """A JSON report (K6): seq and the item as one line of JSON, without what is null."""
    return items.select("seq", F.to_json(F.struct("location", "kind", "detail", "outcome", "losses", "reason")).alias("line"))


def report_lines(items: DataFrame) -> DataFrame:
    """A markdown table of items in order of seq (K6, F3): seq and line."""
    cells = [table_cell(F.col(c)) for c in ("location", "kind", "detail", "outcome")]
    notes = table_cell(F.coalesce(F.col("reason"), F.array_join("losses", "; ")))
    return items.select("seq", F.concat(F.lit("| "), F.concat_ws(" | ", *cells, notes), F.lit(" |")).alias("line"))

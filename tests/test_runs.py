"""A migration from end to end: extract, load, increment, load, and the same state at both ends."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline import runs
from ledgerline.sources import adapter, definitions, sinks


def test_extract_increment_and_load(spark):
    rnd = random.Random(1)
    state = lambda: [(rnd.choice(["wells", "pads"]), k, rnd.choice(["a", "b", None]), rnd.randint(0, 1)) for k in rnd.sample(range(200), 150)]
    schema, columns = "dataset string, key long, name string, n long", ["name", "n"]
    first, second = spark.createDataFrame(state() + [("wells", None, "x", 1)], schema), spark.createDataFrame(state(), schema)
    full = runs.extract(first, columns, "run 1")
    target = runs.load(None, full.operations, columns)
    assert target.count() == 150
    delta = runs.increment(full.index, second, columns, "run 2")
    after = runs.load(target, delta.operations, columns).join(delta.index.select("dataset", "feature_id", "key"), ["dataset", "feature_id"])
    pick = lambda df: sorted(map(str, df.select("dataset", "key", "name", "n").collect()))
    assert pick(after) == pick(second)
    again = runs.increment(delta.index, second, columns, "run 3")
    assert again.operations.count() == 0 and again.index.count() == 150
    moved = full.index.join(delta.index.withColumnRenamed("feature_id", "now"), ["dataset", "key"])
    assert moved.where("feature_id <> now").count() == 0
    with pytest.raises(ValueError, match="needs the table"):
        runs.load(None, delta.operations, columns)
    with pytest.raises(ValueError, match="no index of roads"):
        runs.increment(full.index, second.withColumn("dataset", F.lit("roads")), columns, "run 4")
    counts = {r["dataset"]: r["inserted"] for r in full.counts.collect()}
    assert sum(counts.values()) == 150


def test_tables_can_be_inspected(spark, sf_dir):
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "nation")}
    source = adapter.TableSource(sf_dir, tables)
    assert isinstance(source, adapter.SourceAdapter)
    about, items, counts = adapter.inspect(spark, source)
    assert about["detail"] == "2 tables" and counts.first()["items"] == 2
    assert {r["location"]: len(r["losses"]) for r in items.collect()} == {"nation": 1, "orders": 2}
    with pytest.raises(ValueError, match="empty"):
        adapter.inspect(spark, adapter.TableSource("nowhere", {}))


def test_definitions(spark):
    xml = "<?xml version='1.0'?><DEFeatureClassInfo><CatalogPath>\\\\grp\\\\wells</CatalogPath><FeatureType>esriFTAnnotation</FeatureType><SubtypeFieldName>kind</SubtypeFieldName><Subtypes><Subtype><SubtypeCode>1</SubtypeCode><SubtypeName>deep</SubtypeName><FieldInfos><SubtypeFieldInfo><FieldName>status</FieldName><DomainName>Status</DomainName></SubtypeFieldInfo></FieldInfos></Subtype></Subtypes></DEFeatureClassInfo>"
    found = definitions.definitions(spark.createDataFrame([("wells", xml.replace("\\\\", "\\")), ("broken", "<a><b>"), ("none", None)], "name string, definition string"))
    rows = {r["name"]: r for r in found.collect()}
    assert (rows["wells"]["root"], rows["wells"]["group_name"], rows["wells"]["drawn"], rows["wells"]["subtype_field"]) == ("DEFeatureClassInfo", "grp", True, "kind")
    assert rows["broken"]["subtype_field"] is None and rows["none"]["root"] is None
    assert [tuple(r) for r in definitions.subtype_fields(found).collect()] == [("wells", "1", "deep", "status", "Status", None)]


def test_commits_hold_so_many_rows(spark, tmp_path):
    ops = spark.range(23).select(F.lit("d").alias("dataset"), F.col("id").alias("seq"), F.lit("insert").alias("op"))
    commits = sinks.commit_batches(ops, str(tmp_path / "commits"), most_rows=10)
    assert [r["n"] for r in commits.orderBy("batch").collect()] == [10, 10, 3]
    assert len(commits.orderBy("batch").first()["body"].split("\n")) == 10


def test_originals_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([(1, bytearray(b"g"), 4326, None), (2, None, None, None)], "oid long, shape binary, srid int, wkt string")
    assert sinks.keep_originals(rows, str(tmp_path / "native"), "oid", "shape", "srid", "wkt").count() == 1
    items = spark.createDataFrame([(2, "b", "layer", "d", "faithful", None, []), (1, "a|b", "layer", "d\ne", "approximated", None, ["x", "y"])], "seq long, location string, kind string, detail string, outcome string, reason string, losses array<string>")
    sinks.write_report(items, str(tmp_path / "report"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()] == ["| a\\|b | layer | d e | approximated | x; y |", "| b | layer | d | faithful |  |"]

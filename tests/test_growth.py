"""What grows with the input is dealt to tasks, and what is small stays in few files and tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import batches, ordering
from ledgerline.sources import markup, sinks, windows


def test_shards_of_commits_have_no_files_of_their_own(spark, tmp_path):
    ops = spark.range(600).select((F.col("id") % 100).cast("string").alias("dataset"), F.col("id").alias("seq"))
    assert sinks.commit_batches(ops, str(tmp_path / "commits"), most_rows=3).agg(F.sum("n")).first()[0] == 600
    assert len(list((tmp_path / "commits").rglob("*.parquet"))) <= 8


def test_levels_are_joined_without_a_broadcast(spark, monkeypatch):
    plans, own = [], ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or own(df, name))
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "origin string, destination string")
    found = ordering.load_levels(spark.createDataFrame([("a",), ("b",), ("c",)], "dataset string"), edges)
    assert {(r["dataset"], r["level"]) for r in found.collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert len(plans) > 6 and not any("Broadcast" in plan for plan in plans)


def test_a_single_piece_is_gathered_after_sizes_are_known(spark, monkeypatch):
    plans, own = [], batches.stored
    monkeypatch.setattr(batches, "stored", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or own(df, name))
    rows = spark.range(20).repartition(4).select(F.lit(1).alias("shard"), "id", F.lit(5).cast("long").alias("bytes"))
    assert batches.greedy_batches(rows, "shard", "id", "bytes", most_rows=7).agg(F.max("batch")).first()[0] == 2
    assert plans and not any("Repartition 1, false" in plan for plan in plans)


def test_small_pages_share_a_task(spark, tmp_path):
    windows.register(spark)
    schema = "layer bigint, generation bigint, id bigint"
    windows.land(spark.range(300).selectExpr("id % 2 AS layer", "id DIV 6 AS generation", "id"), str(tmp_path))
    read = spark.read.format("change_windows").schema(schema).load(str(tmp_path))
    assert read.count() == 300 and read.rdd.getNumPartitions() == 1
    assert read.where("layer = 1 and generation > 40").count() == 27
    pages = windows.packed([("a", 0, 1, windows.PACKED), ("b", 0, 2, 5), ("c", 0, 3, 5)])
    assert [[page[0] for page in part.pages] for part in pages] == [["a"], ["b", "c"]]


def test_documents_are_dealt_to_tasks_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(markup, "PARSED", 10_000)
    documents = spark.range(100).coalesce(1).select("id", F.lit("<kml><Placemark/></kml>").alias("body"))
    rows = markup.element_rows(documents, "id", "body")
    assert rows.rdd.getNumPartitions() == 3 and rows.count() == 200


def test_row_kinds_parse_documents_once(spark):
    body = "<kml><Document><Placemark><Point/><Track/></Placemark><Placemark/><Folder><Point/></Folder></Document></kml>"
    found = markup.row_kinds(markup.element_rows(spark.createDataFrame([(1, body)], "id long, body string"), "id", "body"))
    assert {tuple(r) for r in found.collect()} == {(1, 1, "Point", 1), (1, 1, "none", 1)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1

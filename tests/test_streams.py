"""Classifying streams: from an index, over restarts, and against the comparison of tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import diff
from ledgerline.sources import windows
from ledgerline.streaming import classify

ROWS = "dataset string, oid long, seq long, hash string, gone boolean, new_id string"
INDEX = "dataset string, oid long, feature_id string, hash string"


def run(spark, tmp_path, index):
    stream = spark.readStream.schema(ROWS).json(str(tmp_path / "in"))
    found = classify.classify_stream(stream, index)
    query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    return spark.read.schema(found.schema).parquet(str(tmp_path / "out"))


def ordered(df):
    return sorted(map(str, (tuple(r[c] for c in ("dataset", "oid", "seq", "op", "feature_id")) for r in df.collect())))


def test_a_seeded_stream_goes_on_after_a_restart(spark, tmp_path):
    rnd = random.Random(3)
    index = spark.createDataFrame([(d, k, f"{d}{k}", rnd.choice("ab")) for d in "xy" for k in range(12) if rnd.random() < 0.6], INDEX)
    rows = [(rnd.choice("xy"), rnd.randrange(15), k, rnd.choice("ab"), rnd.random() < 0.2, f"n{k}") for k in range(160)]
    for part in (rows[:70], rows[70:]):
        spark.createDataFrame(part, ROWS).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        found = run(spark, tmp_path, index)  # the second run goes on from the checkpoint of the first
    expected = classify.classify_batch(spark.createDataFrame(rows, ROWS), index)
    assert ordered(found) == ordered(expected) and found.count() == len(rows)
    state = {(r["dataset"], r["oid"]): r["hash"] for r in index.collect()}
    for d, k, _, hashed, gone, _ in rows:
        state[d, k] = None if gone else hashed
    held = {(r["dataset"], r["oid"]): r["hash"] for r in classify.held_states(spark, str(tmp_path / "state")).collect()}
    assert held == {k: v for k, v in state.items() if v is not None}


def test_a_window_of_a_seeded_stream_is_the_feed_diff(spark, tmp_path):
    rnd = random.Random(5)
    before = {k: rnd.choice("ab") for k in range(80) if rnd.random() < 0.7}
    edits = {k: (rnd.choice("ab"), rnd.random() < 0.3) for k in rnd.sample(range(100), 50)}
    index = spark.createDataFrame([("d", k, f"f{k}", h) for k, h in before.items()], INDEX)
    spark.createDataFrame([("d", k, i, h, gone, f"n{k}") for i, (k, (h, gone)) in enumerate(edits.items())], ROWS).write.json(str(tmp_path / "in"))
    found = {r["oid"]: r["op"] for r in run(spark, tmp_path, index).collect()}
    now = {**before, **{k: h for k, (h, gone) in edits.items() if not gone}}
    table = lambda rows: spark.createDataFrame(list(rows.items()), "oid long, hash string")
    ids = lambda keys: spark.createDataFrame([(k,) for k in keys], "oid long")
    named = diff.change_feed_diff(table(before), table(now), ids([k for k, (_, gone) in edits.items() if not gone]), ids([k for k, (_, gone) in edits.items() if gone]), "oid", ["hash"])
    assert found == {r["oid"]: r["op"] for r in named.select("oid", F.col("op")).collect()}


def test_windows_are_read_on_from_where_a_stream_was(spark, tmp_path):
    folder, schema = str(tmp_path / "windows"), "layer bigint, generation bigint, id bigint, state string"
    windows.register(spark)
    edits = lambda generations: spark.createDataFrame([(layer, g, 100 * g + i, f"s{i}") for layer in (0, 1) for g in generations for i in range(5)], schema)
    windows.land(edits([1, 2]), folder)

    def run(name, **options):
        source = spark.readStream.format("change_windows").schema(schema).options(**options).load(folder)
        source.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start(str(tmp_path / name)).awaitTermination()
        return sorted((r["layer"], r["generation"]) for r in spark.read.schema(schema).parquet(str(tmp_path / name)).select("layer", "generation").collect())

    assert run("all") == sorted((layer, g) for layer in (0, 1) for g in (1, 2) for _ in range(5))
    windows.land(edits([3]), folder)
    (tmp_path / "windows" / "layer=0" / "generation=4").mkdir()  # not done yet
    (tmp_path / "windows" / "layer=0" / "generation=4" / "part.json").write_text('{"id": 1}\n')
    assert run("all") == sorted((layer, g) for layer in (0, 1) for g in (1, 2, 3) for _ in range(5))  # window 3 once, 1 and 2 not again
    assert run("some", since='{"0": 2, "1": 3}') == [(0, 3)] * 5
    read = spark.read.format("change_windows").schema(schema).load(folder)
    assert read.where("layer = 1 and generation >= 2").count() == 10 and read.where("id = 300").count() == 2
    assert read.where("layer = 1 and generation = 3").rdd.getNumPartitions() == 1


def test_a_page_that_is_wrong_is_an_error(spark, tmp_path):
    windows.register(spark)
    (tmp_path / "layer=1" / "generation=1").mkdir(parents=True)
    (tmp_path / "layer=1" / "generation=1" / "page.json").write_text("{broken\n")
    (tmp_path / "layer=1" / "generation=1" / "_done").write_text("")
    with pytest.raises(Exception, match="(?s)Expecting property name"):
        spark.read.format("change_windows").schema("layer bigint, id bigint").load(str(tmp_path)).collect()
    assert spark.read.format("change_windows").schema("layer bigint").load(str(tmp_path / "nothing")).count() == 0

"""Loading in order of dependence, and indexes that lie in buckets."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline import runs
from ledgerline.operators import diff, forest, ordering
from ledgerline.sources import logs, sinks


def test_levels(spark):
    names = spark.createDataFrame([(x,) for x in "abcdefg"], "dataset string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "c"), ("d", "e"), ("e", "d"), ("e", "f"), ("nowhere", "g")], "origin string, destination string")
    found = {r["dataset"]: (r["level"], r["reason"]) for r in ordering.load_levels(names, edges).collect()}
    assert found == {"a": (1, None), "g": (1, None), "b": (2, None), "c": (3, None)} | {x: (4, forest.CYCLE) for x in "def"}
    assert ordering.load_levels(names.limit(0), edges).count() == 0


def test_commits_go_out_level_by_level(spark, tmp_path):
    names = spark.createDataFrame([(x,) for x in "abc"], "dataset string")
    levels = ordering.load_levels(names, spark.createDataFrame([("c", "b"), ("b", "a")], "origin string, destination string"))
    commits = spark.createDataFrame([(d, n, f"{d}{n}") for d in "abc" for n in range(3)], "dataset string, batch int, body string")
    attachments = spark.createDataFrame([("c", 0, "C0")], "dataset string, batch int, body string")
    folder = str(tmp_path)

    def send(dataset, batch, body):
        with open(os.path.join(folder, body), "w") as out:
            out.write(str(time.time_ns()))

    assert sinks.each_commit_by_level(commits, attachments, levels, send) == 4
    sent = sorted(os.listdir(folder), key=lambda name: int((tmp_path / name).read_text()))
    assert sent == ["c0", "c1", "c2", "b0", "b1", "b2", "a0", "a1", "a2", "C0"]
    with pytest.raises(ValueError, match="no level of z"):
        sinks.each_commit_by_level(commits.withColumn("dataset", F.lit("z")), attachments, levels, send)


def test_a_bucketed_index_is_not_moved(spark, tmp_path):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("dataset"), F.col("id").alias("key"), (F.col("id") % 10).alias("v"))
    index = logs.write_index(runs.extract(rows, ["v"], "run 1").index, "key_index_of_test", str(tmp_path / "index"), buckets=8)
    met = runs._met(diff.last_per_key(index, ["dataset", "key"], [F.col("ordinal")]), rows, ["v"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert met.where("_id is not null and hash is not null").count() == 2000
    spark.sql("DROP TABLE key_index_of_test")

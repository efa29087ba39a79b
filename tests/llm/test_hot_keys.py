"""Keys that hold half of the rows: the join gives what a plain one gives, and no task meets the key alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common, simhash, url_filter


def largest_share(spark, joined):
    """The largest share of the rows that one task has, where partitions are not put together."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        counts = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return max(counts) / sum(counts)


def test_crowded_keys_are_dealt_apart(spark):
    many = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500).alias("k"), "id")
    few = many.groupBy("k").agg(F.max("id").alias("most"), F.count("*").alias("n"))
    joined = common.dealt_by_count(many, few, "k", ["id"], most=500)
    plain = many.join(few.drop("n"), "k")
    assert sorted(joined.columns) == sorted(plain.columns)
    assert joined.exceptAll(plain.select(joined.columns)).isEmpty() and joined.count() == 20_000
    assert largest_share(spark, joined) < 0.2 < largest_share(spark, plain)


@pytest.mark.parametrize("most", [50_000, 3])
def test_components_around_a_hub(spark, monkeypatch, most):
    monkeypatch.setattr(common, "HUB", most)
    monkeypatch.setattr(common.dealt_by_count, "__defaults__", (most,))
    edges = [(0, k) for k in range(1, 60)] + [(100 + k, 101 + k) for k in range(20)] + [(500, 59), (7, 7)]
    found = {r["a"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in [*range(1, 60), 500]} | {100 + k: 100 for k in range(1, 21)}


def test_scores_do_not_change_with_hubs_in_parts(spark, monkeypatch):
    hosts = spark.createDataFrame([(f"h{k}", float(k == 1), float(k == 2)) for k in range(80)], "host string, trusted double, blocked double")
    edges = spark.createDataFrame([("h0", f"h{k}", 1.0) for k in range(1, 80)] + [(f"h{k}", "h0", 0.5) for k in range(1, 80)] + [("h5", "h6", 2.0)], "src string, dst string, weight double")
    scores = lambda: {r["host"]: (round(r["trust"], 12), round(r["distrust"], 12)) for r in url_filter.propagate(hosts, edges, rounds=4).collect()}
    whole = scores()
    monkeypatch.setattr(url_filter, "HUB", 10)
    monkeypatch.setattr(common.dealt_by_count, "__defaults__", (10,))
    assert scores() == whole

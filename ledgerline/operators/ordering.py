"""The order in which datasets can be loaded (K7): what others depend on comes first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .forest import CYCLE


def load_levels(datasets: DataFrame, relationships: DataFrame) -> DataFrame:
    """dataset, level and reason. datasets: dataset. relationships: origin, destination (by dataset); a destination waits for its origins.

    A dataset that waits for none is of level 1, others are one level behind the last of their origins. Those in or below
    a cycle cannot be put in order: they come last, on one level, with the reason. Sides that are no dataset and datasets that relate to
    themselves wait for nothing. A round closes a level: as many rounds as the longest chain, each over what is still open. Both sides of
    a round's joins grow with the datasets, though their files stay small, so none is broadcast.
    """
    names = stored(datasets.select("dataset").distinct(), "datasets")
    edges = relationships.select("origin", "destination").where("origin <> destination").distinct()
    edges = edges.join(names.select(F.col("dataset").alias("origin")).hint("merge"), "origin", "left_semi").join(names.select(F.col("dataset").alias("destination")).hint("merge"), "destination", "left_semi")
    edges, left, done, level = stored(edges, "edges"), names, None, 0
    while not left.isEmpty():
        level += 1
        ready = stored(left.join(edges.select(F.col("destination").alias("dataset")).distinct().hint("merge"), "dataset", "left_anti"), "level")
        if ready.isEmpty():
            own = left.select("dataset", F.lit(level).alias("level"), F.lit(CYCLE).alias("reason"))
            return own if done is None else done.unionByName(own)
        own = ready.select("dataset", F.lit(level).alias("level"), F.lit(None).cast("string").alias("reason"))
        done = own if done is None else done.unionByName(own)
        left = stored(left.join(ready.hint("merge"), "dataset", "left_anti"), "datasets-left")
        edges = stored(edges.join(ready.select(F.col("dataset").alias("origin")).hint("merge"), "origin", "left_anti"), "edges-left")
    return done if done is not None else names.select("dataset", F.lit(1).alias("level"), F.lit(None).cast("string").alias("reason"))

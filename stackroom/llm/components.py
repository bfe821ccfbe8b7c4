"""Connected components by alternating stars, in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.operators.joins import join_per_key

from .common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each node hands its greater neighbours to the least node around it. Small star: its lesser ones and itself.

    ``edges`` are (a, b) with a > b. A node's least neighbour is one partially aggregated row; a hub's edges are
    split over tasks when they meet it.
    """
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        joined = join_per_key(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), least, ["u"], "inner")
        return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    joined = join_per_key(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), least, ["u"], "inner")
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b").unionAll(own).distinct()


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b) but the least of each component, which is its name.

    Ids are integers. Rounds go on until nothing changes; each is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = materialize(edges, "links")
    before = _state(edges)
    while True:
        last, edges = edges, materialize(_star(_star(edges, True), False), "stars")
        discard(last)
        now = _state(edges)
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = now

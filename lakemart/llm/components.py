"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.tables import Scratch


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of each node that has an edge: ``node, component``.

    ``edges``: two columns of comparable ids, in any direction; repeated edges and loops do no
    harm. Each round links every node's neighbours to the smallest of them, once looking at
    larger and once at smaller ones (alternating large and small stars), which keeps the number
    of edges and halves the depth. A node with very many edges is summed up in each task
    first. Rounds are written to the shared folder.
    """
    a, b = edges.columns[:2]
    pairs = edges.select(
        F.least(a, b).alias("low"), F.greatest(a, b).alias("high")
    ).filter("low < high")
    scratch = Scratch(edges.sparkSession, "components")
    pairs = scratch.staged(pairs.distinct(), "edges")
    before = None
    while True:
        # large star: link each larger neighbour to the smallest of the neighbourhood
        both = pairs.select(F.col("high").alias("n"), F.col("low").alias("m")).unionByName(
            pairs.select(F.col("low").alias("n"), F.col("high").alias("m"))
        )
        least = both.groupBy("n").agg(F.least(F.min("m"), F.first("n")).alias("least"))
        large = (
            both.filter("m > n")
            .join(least, "n")
            .select(F.col("least").alias("low"), F.col("m").alias("high"))
            .distinct()
        )
        large = scratch.staged(large, "edges")
        # small star: link the smaller neighbours and the node itself to the smallest of them
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        joined = large.join(least, "high")
        pairs = (
            joined.select(F.col("least").alias("low"), F.col("low").alias("high"))
            .unionByName(least.select(F.col("least").alias("low"), "high"))
            .filter("low < high")
            .distinct()
        )
        pairs = scratch.staged(pairs, "edges")
        # a star forest, once reached, is changed by neither step
        state = pairs.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("low", "high")).alias("x"),
            F.sum(F.shiftright(F.xxhash64("high", "low"), 24)).alias("s"),
        ).first()
        if state == before:
            break
        before = state
    scratch.keep_last()
    scratch.close()
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )

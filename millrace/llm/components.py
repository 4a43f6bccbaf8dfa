"""Connected components by alternating large and small stars, on Spark tables only.

Edges first shrink to a forest within each partition (union-find over that partition's
own edges).  A small forest is then finished in one task (its size is checked).  Else, until nothing changes, every node links its larger neighbours to its
least neighbour (large star) and its smaller ones likewise (small star).  Each round is
written to the shared folder, so lineage does not grow; nothing comes to the driver but
a count and a checksum.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch

#: Forests of at most so many edges (some 10 MB) are finished in one task instead of in rounds.
LOCAL_EDGES = 250_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict = {}
    schema = None

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if schema:
        pairs = [(x, root(x)) for x in parent]
        pairs = [p for p in pairs if p[0] != p[1]]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], schema.field(k).type) for k in (0, 1)], ["u", "v"])


def _named(stars: DataFrame) -> DataFrame:
    """(node, component) of edges (node, least node)."""
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of an edge with the least node it is linked to."""
    kind = edges.schema[a].dataType.simpleString()
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    e = scratch.table(e.mapInArrow(_forest, f"u {kind}, v {kind}"), "edges")
    if e.count() <= LOCAL_EDGES:
        e = scratch.table(e.repartition(1).mapInArrow(_forest, f"u {kind}, v {kind}"), "components")
        return _named(e)
    seen = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).distinct()
        new = scratch.table(small, "edges")
        told = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(e)
        e = new
        if (told.n, told.h) == seen:
            return _named(e)
        seen = (told.n, told.h)

"""Embedding near-dedup: Euclidean p-stable hashing, then exact cosines.

Vectors of one label are compared (labels null: with nothing).  Equal vectors count as one
class.  A class's normalised vector is projected on Gaussian directions, shifted and cut
to cells of `CELL`; `BITS` cells make a bucket, in each of `TABLES` tables.  Cosine 0.98 is
a distance of 0.2: a projection keeps such a pair in one cell with probability 0.82, a
table with 0.21, and all tables miss it with 1.2e-5; closer pairs are missed less.

Only buckets of two classes or more are compared: inside a task, by exact cosines in
double precision, each pair in the first table that has it.  A bucket gives one row per
member (its links' count) and a spanning forest of its links, never the pairs; buckets of
over `BLOCK` members are compared in pairs of blocks.

Defined cases.  Vectors that are null, empty, zero, or hold null or non-finite components
link with nothing; vectors of different lengths are not compared.  A vector whose squared
norm overflows or underflows a double links with its equals only.  Repeated rows are
vectors of their own that link with one another.  Rows with equal or null ids are fine;
the component id is the least non-null id, and a null id is kept if its component has no
other.  Empty table: empty result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch
from millrace.llm import textkernel as K
from millrace.llm.components import components

COSINE = 0.98
TABLES, BITS, CELL = 48, 8, 0.9
SEED = 7
BLOCK = 2048
_PAIRS = 1 << 16

_projections: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}


def _projection(dim: int, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    if (dim, tables, bits) not in _projections:
        rng = np.random.Generator(np.random.PCG64([SEED, dim]))
        _projections[dim, tables, bits] = rng.standard_normal((dim, tables * bits)), rng.uniform(0, CELL, tables * bits)
    return _projections[dim, tables, bits]


def buckets(vectors: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """Bucket of each row (a non-zero vector) in each table."""
    directions, shift = _projection(vectors.shape[1], tables, bits)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cells = np.floor((unit @ directions + shift) / CELL).astype(np.int64).view(np.uint64).reshape(len(vectors), tables, bits)
    h = np.full((len(vectors), tables), vectors.shape[1], np.uint64) + np.arange(tables, dtype=np.uint64)
    for b in range(bits):
        h = K.mix(h ^ (cells[:, :, b] * np.uint64(0x9E3779B97F4A7C15)))
    return h.view(np.int64)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, label, copies, vector) to (cid, label, copies, vector as bytes, buckets)."""
    for batch in batches:
        lists = batch.column(3)
        values, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
        found = np.empty((len(batch), TABLES), np.int64)
        dims = np.diff(offsets)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            found[at] = buckets(np.stack([values[offsets[i] : offsets[i + 1]] for i in at.tolist()]).astype(np.float64))
        raw = [values[a:b].astype(np.float64).tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        wide = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * TABLES), pa.array(found.reshape(-1)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(raw, pa.binary()), wide], ["cid", "label", "copies", "vector", "buckets"])


def _bucket_links(rows: list[tuple], table: int, apart: bool, cosine: float) -> list[tuple]:
    """(cid, links, other) for each member that has links here; other: its parent in a spanning forest, or None."""
    ids = [r[0] for r in rows]
    copies = np.array([r[1] for r in rows], np.int64)
    vectors = np.stack([np.frombuffer(r[2], np.float64) for r in rows])
    found = np.array([r[3] for r in rows], np.int64)
    side = np.array([r[4] for r in rows])
    norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    links = np.zeros(len(rows), np.int64)
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    step = max(1, (1 << 22) // len(rows))
    for i in range(0, len(rows), step):
        cos = (vectors[i : i + step] @ vectors.T) / (norm[i : i + step, None] * norm[None, :])
        close = cos >= cosine
        if apart:
            close &= side[i : i + step, None] != side[None, :]
        a, b = np.nonzero(close)
        a = a + i
        keep = a < b
        a, b = a[keep], b[keep]
        for k in range(0, len(a), _PAIRS):
            x, y = a[k : k + _PAIRS], b[k : k + _PAIRS]
            mine = (found[x, : table + 1] == found[y, : table + 1]).argmax(axis=1) == table
            x, y = x[mine], y[mine]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            for p, q in zip(x.tolist(), y.tolist(), strict=True):
                p, q = root(p), root(q)
                if p != q:
                    parent[max(p, q)] = min(p, q)
    return [(ids[k], int(links[k]), ids[root(k)] if root(k) != k else None) for k in np.flatnonzero(links).tolist()]


def _compare(cosine: float):
    """Rows (table, label, bucket, low, high, cid, copies, vector, buckets, side), sorted by the first five, to (cid, links, other)."""
    def flush(now, rows):
        out = _bucket_links(rows, now[0], now[3] != now[4], cosine)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.binary()))], ["cid", "links", "other"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != row[:5]:
                    if len(rows) > 1:
                        yield flush(now, rows)
                    now, rows = row[:5], []
                rows.append(row[5:])
        if len(rows) > 1:
            yield flush(now, rows)

    return compare


def dedup(rows: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """Per row: id, n_links (other vectors linked directly), component_id (least id linked, however far) and kept."""
    spark = rows.sparkSession
    scratch.prepare(spark, 2048)
    v = F.col("v")
    base = rows.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.coalesce(F.col("label").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    digits = lambda h: F.lpad(F.hex(h), 16, "0")
    base = base.withColumn("cid", F.when(fine, F.unhex(F.concat(digits(F.xxhash64("label", "v")), digits(F.xxhash64("v", "label"))))))
    classes = base.where("cid is not null").groupBy("cid").agg(F.first("label").alias("label"), F.count("*").alias("copies"), F.first("v").alias("v"))
    kind = base.schema["label"].dataType.simpleString()
    hashed = scratch.table(classes.select("cid", "label", "copies", "v").mapInArrow(_hash, f"cid binary, label {kind}, copies bigint, vector binary, buckets array<bigint>"), "hashed")
    thin = hashed.select("cid", "label", F.posexplode("buckets").alias("t", "bucket"))
    many = thin.groupBy("label", "t", "bucket").agg(F.count("*").alias("members")).where("members > 1")
    n = scratch.partitions(spark)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    full = thin.join(many, ["label", "t", "bucket"]).select("cid", "t", "label", "bucket", F.pmod(F.hash("cid"), blocks).alias("side"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("x"))
    full = full.withColumnRenamed("label", "of").join(hashed.select("cid", "copies", "vector", "buckets"), "cid")
    full = full.select("t", "of", "bucket", F.least("side", "x").alias("low"), F.greatest("side", "x").alias("high"), "cid", "copies", "vector", "buckets", "side")
    keys = ["t", "of", "bucket", "low", "high"]
    links = scratch.table(full.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(_compare(cosine), "cid binary, links bigint, other binary"), "links")
    groups = components(links.where("other is not null").select("cid", "other"), "cid", "other")
    told = base.select("id", "cid").join(links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(hashed.select("cid", "copies"), "cid", "left")
    told = told.join(groups.select(F.col("node").alias("cid"), "component"), "cid", "left").select("id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("bigint").alias("n_links"), F.coalesce("component", "cid").alias("component"))
    told = scratch.table(told, "told")
    least = scratch.table(told.where("component is not null").groupBy("component").agg(F.min("id").alias("least")), "least")
    got = told.join(least, "component", "left").select("id", "n_links", F.coalesce("least", "id").alias("component_id"))
    return got.select(F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

"""Counting hashes of all documents with a shuffle of packed arrays.

Native rows of (hash, document) cost some 30 bytes and a JVM row each.  Here a block of
documents sends, for each slice of the hash space, one row that holds its hashes of
that slice as bytes: about 6 or 8 bytes a hash, and no object per hash.  A reducer joins
all arrays of its slices, sorts them with numpy and answers per block; a second, small
exchange brings the answers of a block together again.

Slices are as many as ``spark.sql.shuffle.partitions`` and their labels are chosen so
that each falls into a partition of its own: a reducer's memory is the input's hashes
divided by that number, and follows the setting, not the input.  Hot hashes only make
longer runs in a sorted array.

Which document a hash belongs to goes as counts of all the block's documents while these
are fewer bytes, else as a number for each hash: so a row is as large as its hashes,
whatever the number of slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.llm import scratch
from millrace.llm import textkernel as K

#: A row of the exchange; `slice` -1 would be a header, which carries a block's documents.
SCHEMA = "label int, block bigint, slice int, owners binary, hashes binary, ids binary"
_ARROW = pa.schema([("label", pa.int32()), ("block", pa.int64()), ("slice", pa.int32()), ("owners", pa.binary()), ("hashes", pa.binary()), ("ids", pa.binary())])
HEADER = -1


def labels(spark: SparkSession) -> np.ndarray:
    """One int for each shuffle partition which Spark's hash partitioning puts there."""
    n = scratch.partitions(spark)
    rows = spark.range(0, 24 * n + 64).select(F.col("id").cast("int").alias("id")).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
    found = {r.p: r.id for r in rows}
    return np.array([found.get(p, p) for p in range(n)], np.int32)


def slice_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Slice 0..n-1 of 64-bit hashes: equal parts of the hash space, in its order."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


def narrow(hashes: np.ndarray, size: int) -> bytes:
    """The high `size` bytes of each hash."""
    if size == 8:
        return hashes.tobytes()
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, 8 - size :]).tobytes()


def widen(raw: bytes, size: int) -> np.ndarray:
    if size == 8:
        return np.frombuffer(raw, np.uint64)
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, 8 - size :] = np.frombuffer(raw, np.uint8).reshape(-1, size)
    return out.view(np.uint64).reshape(-1)


def pack_owners(row: np.ndarray, n_rows: int) -> bytes:
    """Rows (ascending) that hashes belong to: a count of each of the block's rows, or, if that is shorter, the rows themselves."""
    kind = np.uint16 if n_rows <= 65536 else np.uint32
    if 4 * n_rows <= len(row) * np.dtype(kind).itemsize:
        return b"c" + np.bincount(row, minlength=n_rows).astype(np.uint32).tobytes()
    return (b"s" if kind is np.uint16 else b"l") + row.astype(kind).tobytes()


def owners(raw: bytes) -> np.ndarray:
    """The rows that `pack_owners` packed."""
    if raw[:1] == b"c":
        counts = np.frombuffer(raw, np.uint32, -1, 1) if len(raw) > 1 else np.empty(0, np.uint32)
        return np.repeat(np.arange(len(counts)), counts)
    kind = np.uint16 if raw[:1] == b"s" else np.uint32
    return (np.frombuffer(raw, kind, -1, 1) if len(raw) > 1 else np.empty(0, kind)).astype(np.int64)


def pack(block: int, at: np.ndarray, row: np.ndarray, n_rows: int, hashes: np.ndarray, size: int, header: tuple[bytes, bytes], ids: bytes = b"", more: np.ndarray | None = None) -> pa.RecordBatch:
    """The rows of one block: its header, then its hashes by slice, in their order; row: of each hash, ascending; ids: goes with every slice; more: a second number of each hash."""
    n = len(at)
    own = slice_of(hashes, n)
    order = np.argsort(own.astype(np.uint16) if n < 65536 else own, kind="stable")
    hashes, row, own = hashes[order], row[order], own[order]
    edge = np.searchsorted(own, np.arange(n + 1))
    used = np.flatnonzero(np.diff(edge))
    whose = [pack_owners(row[edge[s] : edge[s + 1]], n_rows) for s in used]
    sent = [narrow(hashes[edge[s] : edge[s + 1]], size) for s in used]
    if more is not None:
        more = more[order]
        sent = [x + more[edge[s] : edge[s + 1]].tobytes() for x, s in zip(sent, used, strict=True)]
    home = at[block % n]
    return pa.RecordBatch.from_arrays(
        [pa.array([home, *at[used]], pa.int32()), pa.array([block] * (len(used) + 1), pa.int64()), pa.array([HEADER, *used], pa.int32()), pa.array([header[0], *whose], pa.binary()), pa.array([header[1], *sent], pa.binary()), pa.array([b"", *[ids] * len(used)], pa.binary())],
        schema=_ARROW,
    )


def block_id(*arrays: np.ndarray) -> int:
    """A number that a block has whenever it is computed again; positive."""
    h = np.uint64(1469598103934665603)
    for a in arrays:
        x = K.mix(a.astype(np.int64, copy=False).view(np.uint64) + np.arange(1, len(a) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        h = K.mix(np.array([h ^ np.bitwise_xor.reduce(x, initial=np.uint64(len(a)))], np.uint64))[0]
    return int(h >> np.uint64(1))


class Gathered:
    """All rows of a reducer's partition."""

    def __init__(self, batches: Iterator[pa.RecordBatch], size: int, more: bool = False):
        self.headers: list[tuple[int, bytes, bytes]] = []
        self.parts: list[tuple[int, int, bytes, bytes]] = []
        raw = []
        for batch in batches:
            for block, s, whose, hashes, ids in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4, 5)), strict=True):
                if s == HEADER:
                    self.headers.append((block, whose, hashes))
                else:
                    self.parts.append((block, s, whose, ids))
                    raw.append(hashes)
        whole = size + 8 * more
        sizes = np.array([len(x) // whole for x in raw], np.int64)
        self.hashes = widen(b"".join([x[: n * size] for x, n in zip(raw, sizes.tolist(), strict=True)]) if more else b"".join(raw), size)
        self.more = np.frombuffer(b"".join([x[n * size :] for x, n in zip(raw, sizes.tolist(), strict=True)]), np.uint64) if more else None
        self.edge = np.concatenate(([0], np.cumsum(sizes)))

    def ranked(self) -> tuple[np.ndarray, np.ndarray]:
        """Order by hash, and where the runs of equal hashes start."""
        order = np.argsort(self.hashes, kind="stable")
        s = self.hashes[order]
        return order, np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)

    def answers(self, bodies: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
        """Answer rows (block, slice, owners, body), and the headers that came here."""
        rows = [(b, HEADER, x, y) for b, x, y in self.headers] + bodies
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["block", "slice", "owners", "body"])


ANSWER = "block bigint, slice int, owners binary, body binary"


def blocks_of(batches: Iterator[pa.RecordBatch], quiet: bool = False) -> Iterator[tuple[bytes, bytes, dict[int, tuple[bytes, bytes]]]]:
    """Header and answers by slice of each block of this partition; quiet: of blocks without answers too."""
    headers: dict[int, tuple[bytes, bytes]] = {}
    bodies: dict[int, dict[int, tuple[bytes, bytes]]] = {}
    for batch in batches:
        for block, s, whose, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if s == HEADER:
                headers[block] = (whose, body)
            else:
                bodies.setdefault(block, {})[s] = (whose, body)
    for block in headers if quiet else bodies:
        yield *headers[block], bodies.get(block, {})


def order_sent(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which `pack` sends hashes, and each slice's place in it."""
    own = slice_of(hashes, n)
    order = np.argsort(own.astype(np.uint16) if n < 65536 else own, kind="stable")
    return order, np.searchsorted(own[order], np.arange(n + 1))


def exchange(df, send, reduce, regroup, schema: str):
    """send: blocks to packed rows; reduce: a partition's slices to answers; regroup: a partition's blocks to rows of `schema`."""
    n = scratch.partitions(df.sparkSession)
    answers = df.mapInArrow(send, SCHEMA).repartition(n, "label").mapInArrow(reduce, ANSWER)
    return answers.repartition(n, "block").mapInArrow(regroup, schema)

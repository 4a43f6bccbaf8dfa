"""Near pairs of word sets, found on 64-bit hashes of the words.

Three scans of the texts, none of which shuffles them:

1. every row's class (a hash of its whole set; rows with equal sets are one class), and how
   often words fall into each of 2^24 buckets;
2. each class posts the n - ceil(t*n) + 1 words of its set that come first in the order
   (bucket count, hash), which any order makes exact and a rare-first one makes short.
   Classes meet under a word where their sizes and the places of the word let them link;
3. sets of classes that met go to where their pairs are compared, once for each group of
   pairs (those under the least class that the first of a pair met).

All pairs that the posted words allow are compared on the whole sets.  n different words
have n^2/2^65 equal hashes expected (0.0003 for 10^8).  The driver holds
a byte a bucket and 8 bytes a class that met; a task the sets of its groups of pairs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import tables
from millrace.shipping import ship

BUCKET_BITS, LANE_BITS = 24, 6
#: Entries held before they are passed on.
HELD = 1 << 22
KNOWN_WORDS = 1 << 20
#: str.split() also splits at these, which aren't blanks in Unicode.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SLACK = 1e-9


class _Hashes(dict):
    """64-bit hashes of words, computed once while they fit."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little")
        return h


def _sets(texts: pa.Array, known: _Hashes) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted word hashes of each lower-case text that has words."""
    for k, value in enumerate(texts):
        text = value.as_py()
        if not text:
            continue
        words = set(_BLANKS.split(text)) - {""} if _SEPARATORS.search(text) else set(text.split())
        if words:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            h.sort()
            yield k, h


def _class(h: np.ndarray) -> int:
    return int.from_bytes(blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, cls, n), and to packed bucket counts by lane."""
    known, held, size, kind = _Hashes(), [], 0, None
    names = ["id", "cls", "lane", "body"]

    def counts() -> pa.RecordBatch:
        bucket, n = np.unique(np.concatenate(held), return_counts=True)
        shift = np.uint32(BUCKET_BITS - LANE_BITS)
        edge = np.searchsorted(bucket >> shift, np.arange((1 << LANE_BITS) + 1))
        lanes = np.flatnonzero(np.diff(edge))
        body = [(bucket[edge[s] : edge[s + 1]] & np.uint32((1 << int(shift)) - 1)).tobytes() + n[edge[s] : edge[s + 1]].astype(np.uint32).tobytes() for s in lanes]
        return pa.RecordBatch.from_arrays([pa.nulls(len(lanes), kind), pa.nulls(len(lanes), pa.int64()), pa.array(lanes, pa.int32()), pa.array(body, pa.binary())], names)

    for batch in batches:
        kind = batch.schema.field(0).type
        at, cls = [], []
        for k, h in _sets(batch.column(1), known):
            at.append(k)
            cls.append(_class(h))
            held.append(_bucket(h))
            size += len(h)
            if size >= HELD:
                yield counts()
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(cls, pa.int64()), pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary())], names)
    if held:
        yield counts()


def _ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed counts to a byte for each bucket of a lane: eight steps to every doubling of its count."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for lane, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            bucket, n = np.frombuffer(body, np.uint32).reshape(2, -1)
            sums.setdefault(lane, np.zeros(1 << (BUCKET_BITS - LANE_BITS), np.int64))[bucket] += n
    ranks = [np.minimum(8 * np.log2(1 + x), 255).astype(np.uint8).tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())], ["lane", "ranks"])


def _posted(ranks, threshold: float):
    """(text) to (word, cls, at) of the posted words; at: the set's size, and the word's place in the set's order."""
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, order = _Hashes(), np.frombuffer(ranks.value, np.uint8)
        for batch in batches:
            word, cls, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for _, h in _sets(batch.column(0), known):
                n = len(h)
                first = np.argsort(order[_bucket(h)], kind="stable")[: n - math.ceil(threshold * n - _SLACK) + 1]
                word.append(h[first])
                cls.append(np.full(len(first), _class(h)))
                at.append((n << 32) + np.arange(len(first)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(word).view(np.int64)), pa.array(np.concatenate(cls)), pa.array(np.concatenate(at))], ["word", "cls", "at"])

    return post


def _met(threshold: float):
    """(word, cls, at) of whole words to pairs of classes (x, y), x < y, that may link."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
        if not parts:
            return
        word, cls, at = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((cls, at, word))  # by size in a word's run; rows of one class have one `at`
        word, cls, at = word[order], cls[order], at[order]
        new = np.concatenate(([True], (word[1:] != word[:-1]) | (cls[1:] != cls[:-1])))
        word, cls, n, place = word[new], cls[new], at[new] >> 32, at[new] & 0xFFFFFFFF
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        ends = np.concatenate((starts[1:], [len(word)]))
        end = np.repeat(ends, ends - starts)
        found, size, alive, step = [], 0, np.arange(len(word)), 1
        while len(alive):
            alive = alive[alive + step < end[alive]]
            alive = alive[n[alive] >= threshold * n[alive + step] - _SLACK]
            other = alive + step
            # Under the first word that two sets share, no more can be shared than what follows it in both.
            fit = np.minimum(n[alive] - place[alive], n[other] - place[other]) >= threshold / (1 + threshold) * (n[alive] + n[other]) - 1e-6
            a, b = cls[alive[fit]], cls[other[fit]]
            found.append(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1))
            size += len(a)
            if size >= HELD // 4:
                yield _pairs(found)
                found, size = [], 0
            step += 1
        yield _pairs(found)

    return meet


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    both = np.concatenate([*found, np.empty((0, 2), np.int64)])
    both = both[np.lexsort((both[:, 1], both[:, 0]))]
    if len(both):
        both = both[np.concatenate(([True], (both[1:] != both[:-1]).any(axis=1)))]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, k])) for k in (0, 1)], ["x", "y"])


def _asked(wanted):
    """(key, text) to (cls, body), the packed sets of rows whose key may be wanted."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            held = flagged(batch.column(0), wanted.value)
            cls, body = [], []
            for _, h in _sets(batch.column(1).take(pa.array(held)), known):
                cls.append(_class(h))
                body.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(body, pa.binary())], ["cls", "body"])

    return ask


def flags(keys: np.ndarray) -> bytes:
    """A bit for each key, in 32 to 64 bits a key (128 MB at most)."""
    size = 1 << min(max(16, int(32 * len(keys)).bit_length()), 30)
    bits = np.zeros(size >> 3, np.uint8)
    at = keys % np.uint64(size)
    np.bitwise_or.at(bits, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))
    return bits.tobytes()


def flagged(keys: pa.Array, raw: bytes) -> np.ndarray:
    """Places of the keys whose bit is set."""
    bits = np.frombuffer(raw, np.uint8)
    at = keys.to_numpy().view(np.uint64) % np.uint64(8 * len(bits))
    return np.flatnonzero(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()], pa.binary())], ["keys"])


def _linked(threshold: float):
    """Pairs (x, y) and sets (cls, body) that belong to them, of one partition, to pairs with that similarity."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        parts = []
        for batch in batches:
            for cls, body in zip(batch.column("cls").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if body is not None and cls not in sets:
                    sets[cls] = np.frombuffer(body, np.uint64)
            pairs = batch.filter(batch.column("x").is_valid())
            parts.append(np.stack([pairs.column(c).to_numpy() for c in ("x", "y")], axis=1))
        if not parts:
            return
        both = np.concatenate(parts)
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        edge = np.flatnonzero(np.concatenate(([True], both[1:, 0] != both[:-1, 0], [True]))) if len(both) else np.zeros(1, int)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            own = sets[int(both[a, 0])]
            for lo in range(a, b, 256):
                some = both[lo : min(b, lo + 256)]
                others = [sets[y] for y in some[:, 1].tolist()]
                n = np.array([len(o) for o in others])
                joined = np.concatenate(others)
                at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
                shared = np.add.reduceat((own[at] == joined).astype(np.int64), np.concatenate(([0], np.cumsum(n)[:-1])))
                fine = some[shared / (len(own) + n - shared) >= threshold]
                if len(fine):
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(fine[:, k])) for k in (0, 1)], ["x", "y"])

    return link


def near_classes(rows: DataFrame, id: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, cls) of all rows with words, and the pairs of classes (x, y), x < y, whose sets have that Jaccard similarity."""
    spark = rows.sparkSession
    ship(spark)
    broadcast = spark.sparkContext.broadcast
    lower = F.lower(F.col(text))
    kind = rows.schema[id].dataType.simpleString()
    first = tables.table(rows.select(F.col(id).alias("id"), lower.alias("text")).mapInArrow(_classes, f"id {kind}, cls bigint, lane int, body binary"), "classes")
    own = first.where("lane is null").select("id", "cls")
    ranks = bytearray(1 << BUCKET_BITS)
    for r in first.where("lane is not null").select("lane", "body").repartition("lane").mapInArrow(_ranks, "lane int, ranks binary").collect():
        ranks[r.lane * len(r.ranks) : (r.lane + 1) * len(r.ranks)] = r.ranks
    posted = rows.select(lower.alias("text")).mapInArrow(_posted(broadcast(bytes(ranks)), threshold), "word bigint, cls bigint, at bigint")
    met = tables.table(posted.repartition("word").mapInArrow(_met(threshold), "x bigint, y bigint").distinct(), "met")

    # One row of each class that met is asked for its set, through a bit for each of their hashed ids.
    either = met.select(F.col("x").alias("cls"), F.col("y").alias("other")).union(met.select("y", "x"))
    least = either.groupBy("cls").agg(F.least("cls", F.min("other")).alias("part"))
    least = tables.table(least, "least")
    rep = own.join(least.select("cls"), "cls").groupBy("cls").agg(F.min("id").alias("id")).select(F.xxhash64("id").alias("key"))
    keys = np.frombuffer(b"".join(bytes(r.keys) for r in rep.mapInArrow(packed, "keys binary").collect()), np.uint64)
    sets = rows.select(F.xxhash64(F.col(id)).alias("key"), lower.alias("text")).mapInArrow(_asked(broadcast(flags(keys))), "cls bigint, body binary").dropDuplicates(["cls"])

    placed = met.join(least.withColumnRenamed("cls", "x"), "x")
    need = placed.select("part", F.col("x").alias("cls")).union(placed.select("part", "y")).distinct()
    none = F.lit(None)
    work = placed.select("part", "x", "y", none.cast("bigint").alias("cls"), none.cast("binary").alias("body")).union(
        need.join(sets, "cls").select("part", none.cast("bigint"), none.cast("bigint"), "cls", "body")
    )
    return own, tables.table(work.repartition("part").mapInArrow(_linked(threshold), "x bigint, y bigint"), "near")

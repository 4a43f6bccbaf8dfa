"""Substring dedup: repeated windows of words, found by Rabin-Karp hashes counted in Spark.

A word is a maximal run of non-blank bytes, unchanged.  Every window of `width`
consecutive words of a document gets a Rabin-Karp hash (64 bits, over the words' own
64-bit hashes).  All windows of all documents are brought together by hash (see
``slices``); a window is marked when its hash also occurs in a document with a smaller
id.  The marks go back as bits; each document merges its marked windows to maximal
intervals of words and drops those words.  Marks are made on the input, never on what
is left.

At n windows the expected number of false matches is n**2 / 2**65: 0.0004 for 10**8.

Defined cases.  Null or blank texts have no words; texts of fewer words than a window
keep all.  Ids are whole numbers (a text that is none ends the query with Spark's cast
error, or counts as null without ANSI mode).  Null ids come after all others, and never repeat one another.  Rows with equal
ids are one document for the comparison (neither is smaller) and are cut each by itself.
Empty table: empty result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, slices
from millrace.llm import textkernel as K

WIDTH = 50
_NONE = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NONE).to_numpy(zero_copy_only=False).astype(np.int64)


def _windows(w: K.Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and row of every window inside one row."""
    h = K.window_hashes(w.hash, width)
    at = np.flatnonzero(K.windows_within(w.first, width, len(w.hash)))
    return h[at], at, (np.searchsorted(w.first, at, "right") - 1).astype(np.int64)


def _send(at: np.ndarray, width: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = _ids(batch.column(0)), batch.column(1).to_numpy()
            data, offsets = K.rows_of(batch.column(2))
            for i, j in K.blocks(offsets):
                h, _, row = _windows(K.words_of(data, offsets[i : j + 1], K.BLANK, lower=False), width)
                if len(h):
                    own = ids[i:j].tobytes()
                    yield slices.pack(slices.block_id(ids[i:j], keys[i:j]), at, row, j - i, h, 8, (own, keys[i:j].tobytes()), own)

    return send


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bit for each window: its hash also occurs under a smaller id.  Slices without any give no answer."""
    got = slices.Gathered(batches, 8)
    bodies = []
    if got.parts:
        order, starts = got.ranked()
        owner = np.concatenate([np.frombuffer(ids, np.int64)[slices.owners(whose)] for _, _, whose, ids in got.parts])[order]
        least = np.minimum.reduceat(owner, starts)
        marked = np.empty(len(order), bool)
        marked[order] = owner > np.repeat(least, np.diff(np.append(starts, len(order))))
        for (block, s, whose, _), a, b in zip(got.parts, got.edge[:-1].tolist(), got.edge[1:].tolist(), strict=True):
            if marked[a:b].any():
                bodies.append((block, s, whose, np.packbits(marked[a:b]).tobytes()))
    yield got.answers(bodies)


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, bits): for each document with marks, its bits by slice, in the order of its windows there."""
    for ids, keys, found in slices.blocks_of(batches):
        ids, keys = np.frombuffer(ids, np.int64), np.frombuffer(keys, np.int64)
        out: dict[int, list[bytes]] = {}
        for s, (whose, body) in sorted(found.items()):
            owner = slices.owners(whose)
            bits = np.unpackbits(np.frombuffer(body, np.uint8), count=len(owner))
            for row in np.unique(owner[bits > 0]).tolist():
                own = bits[np.searchsorted(owner, row) : np.searchsorted(owner, row, "right")]
                out.setdefault(row, []).append(np.array([s, len(own)], np.uint32).tobytes() + np.packbits(own).tobytes())
        rows = sorted(out)
        yield pa.RecordBatch.from_arrays([pa.array(ids[rows], pa.int64()), pa.array(keys[rows], pa.int64()), pa.array([b"".join(out[r]) for r in rows], pa.binary())], ["id", "key", "bits"])


def _marked(bits: bytes, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of a document's windows are marked."""
    own = slices.slice_of(hashes, n)
    order = np.argsort(own, kind="stable")
    edge = np.searchsorted(own[order], np.arange(n + 1))
    out, at = np.zeros(len(hashes), bool), 0
    while at < len(bits):
        s, count = np.frombuffer(bits, np.uint32, 2, at).tolist()
        size = -(-count // 8)
        out[order[edge[s] : edge[s + 1]]] = np.unpackbits(np.frombuffer(bits, np.uint8, size, at + 8), count=count)
        at += 8 + size
    return out


def _cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Words covered by windows that start at `starts`."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64())]))


def _cut(n_slices: int, width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.rows_of(batch.column(1))
            bits = batch.column(2).to_pylist()
            n_words, spans, kept = [], [], []
            for i, j in K.blocks(offsets):
                w = K.words_of(data, offsets[i : j + 1], K.BLANK, lower=False)
                raw = w.data.tobytes()
                for row in range(j - i):
                    lo, hi = int(w.first[row]), int(w.first[row + 1])
                    keep, own = np.ones(hi - lo, bool), []
                    if bits[i + row]:
                        at = np.flatnonzero(_marked(bits[i + row], K.window_hashes(w.hash[lo:hi], width), n_slices))
                        keep = ~_cover(at, width, hi - lo)
                        step = np.diff(np.concatenate(([False], ~keep, [False])).astype(np.int8))
                        own = [{"first_word": a, "n_words": b - a} for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)]
                    start, end = w.start[lo:hi][keep], w.end[lo:hi][keep]
                    n_words.append(hi - lo)
                    spans.append(own)
                    kept.append(b" ".join([raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), K.strings(kept)], ["id", "n_words", "removed", "kept"])

    return cut


def dedup(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per document: id, n_words, removed (maximal intervals of words) and kept (words left, one blank between)."""
    spark = docs.sparkSession
    scratch.prepare(spark)
    n = scratch.partitions(spark)
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("key"), F.col(text).cast("string").alias("text"))
    marks = slices.exchange(rows, _send(slices.labels(spark), width), _mark, _per_document, "id bigint, key bigint, bits binary")
    marks = marks.groupBy("id", "key").agg(F.first("bits").alias("bits"))
    order = F.coalesce(rows.id, F.lit(_NONE))
    joined = rows.withColumn("id_", order).join(marks.select(F.col("id").alias("id_"), "key", "bits"), ["id_", "key"], "left").select("id", "text", "bits")
    got = joined.mapInArrow(_cut(n, width), "id bigint, n_words bigint, removed array<struct<first_word:bigint,n_words:bigint>>, kept string")
    return got.select(F.col("id").alias(id), "n_words", "removed", "kept")

"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Words are maximal runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII
characters.  Each test item gives its windows of `width` consecutive words; an item of
fewer words, but not none, is one window.  The windows' 64-bit hashes are broadcast;
documents are scanned once, without a shuffle, every window of theirs is looked up,
and each match is verified on the words themselves.

Bound of the broadcast: `BLOCK_BYTES` bytes, of 24 for each window and the test texts
themselves, some 5 bytes of them a word.  A larger benchmark is split by item into blocks
of that size (an item of more is a block of its own); the documents are scanned once per block and
the spans found so far travel with them, so any size gives the same result.

Defined cases.  Null or blank texts have no words and are clean.  Null item ids are
written as an empty string; items without words match nothing; items repeated under one
id count once.  An empty benchmark leaves everything clean.  Documents are judged row by
row, so repeated rows and repeated or null ids give one result each.  Only the named
columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch
from millrace.llm import textkernel as K

WIDTH = 10
BLOCK_BYTES = 128_000_000
#: A character of a test text takes 16 bytes at most: itself (4 in UTF-8) and, as every other one may begin a word, half a window.
BLOCK_CHARS = BLOCK_BYTES // (4 + 24 // 2)
_BITS = 18


@dataclass
class Windows:
    """Windows of one length, as arrays: 24 bytes each beside the items' words."""

    width: int
    #: Distinct hashes, ascending, and where the windows of each begin (one more at the end).
    hashes: np.ndarray
    first: np.ndarray
    #: Of each window, by hash: its span in `words`, and its item.
    begin: np.ndarray
    end: np.ndarray
    item: np.ndarray
    filter: np.ndarray = field(repr=False)
    #: All items' words, lower-cased, one blank between; and the items' names (both shared by all lengths).
    words: bytes = field(repr=False)
    names: list[str] = field(repr=False)

    def owners(self, key: int, said: bytes) -> set[str]:
        """Items with a window of that hash and these very words."""
        return {self.names[self.item[k]] for k in range(self.first[key], self.first[key + 1]) if self.words[self.begin[k] : self.end[k]] == said}


def build_windows(items: list[tuple[str, str | None]], width: int) -> list[Windows]:
    names = sorted({item for item, _ in items})
    number = {item: k for k, item in enumerate(names)}
    found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = {}
    words, at = [], 0
    for item, text in items:
        data = np.frombuffer((text or "").encode(), np.uint8)
        w = K.words_of(data, np.array([0, len(data)]), K.NON_ALNUM, lower=True)
        n = len(w.start)
        if n == 0:
            continue
        wide = min(n, width)
        own = [x.lower() for x in w.text(0, n)]
        start = at + np.concatenate(([0], np.cumsum([len(x) + 1 for x in own])))
        words.append(b" ".join(own) + b" ")
        at = int(start[-1])
        h = K.window_hashes(w.hash, wide)
        found.setdefault(wide, []).append((h, start[: len(h)], start[wide : wide + len(h)] - 1, np.full(len(h), number[item], np.int32)))
    blob = b"".join(words)
    out = []
    for wide, parts in sorted(found.items()):
        h, begin, end, item = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        h, begin, end, item = h[order], begin[order], end[order], item[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        bits = np.zeros(1 << _BITS, bool)
        bits[h >> np.uint64(64 - _BITS)] = True
        out.append(Windows(wide, h[first], np.append(first, len(h)), begin, end, item, bits, blob, names))
    return out


def _scan_block(w: K.Words, windows: list[Windows]) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Words hit, and each row's items."""
    total = len(w.start)
    edges = np.zeros(total + 1, np.int32)
    items: dict[int, set[str]] = {}
    for kind in windows:
        h = K.window_hashes(w.hash, kind.width)
        if not len(h):
            continue
        at = np.flatnonzero(kind.filter[h >> np.uint64(64 - _BITS)] & K.windows_within(w.first, kind.width, total))
        near = np.minimum(np.searchsorted(kind.hashes, h[at]), len(kind.hashes) - 1)
        same = kind.hashes[near] == h[at]
        at, near = at[same], near[same]
        rows = np.searchsorted(w.first, at, "right") - 1
        for i, row, key in zip(at.tolist(), rows.tolist(), near.tolist(), strict=True):
            owners = kind.owners(key, b" ".join(w.text(i, i + kind.width)).lower())
            if owners:
                edges[i] += 1
                edges[i + kind.width] -= 1
                items.setdefault(row, set()).update(owners)
    return np.cumsum(edges[:-1]) > 0, items


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


_SPANS = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())]))
_RESULT = "n_words bigint, spans array<struct<first_word:int,n_words:int,begin:bigint,end:bigint>>, items array<string>"


def _scanner(share, text_at: int, earlier: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = share.value
        for batch in batches:
            data, offsets = K.rows_of(batch.column(text_at))
            counts, spans, owners = [], [], []
            for i, j in K.blocks(offsets):
                w = K.words_of(data, offsets[i : j + 1], K.NON_ALNUM, lower=True)
                hit, items = _scan_block(w, windows)
                at = {}
                if hit.any():
                    for row in np.unique(np.searchsorted(w.first, np.flatnonzero(hit), "right") - 1).tolist():
                        lo, hi = int(w.first[row]), int(w.first[row + 1])
                        a, b = _runs(hit[lo:hi])
                        base = int(offsets[i + row] - offsets[i])
                        at[row] = [{"first_word": x, "n_words": y - x, "begin": int(w.start[lo + x]) - base, "end": int(w.end[lo + y - 1]) - base} for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                counts += np.diff(w.first).tolist()
                spans += [at.get(row, []) for row in range(j - i)]
                owners += [sorted(items.get(row, ())) for row in range(j - i)]
            columns = batch.columns
            if earlier:
                spans = [x + (y or []) for x, y in zip(spans, columns[-2].to_pylist(), strict=True)]
                owners = [sorted({*x, *(y or [])}) for x, y in zip(owners, columns[-1].to_pylist(), strict=True)]
                columns = columns[:-3]
            names = batch.schema.names[: len(columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(owners, pa.list_(pa.string()))], [*names, "n_words", "spans", "items"])

    return scan


def scan(docs: DataFrame, benchmark: DataFrame, *, columns: list[str], text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`columns` of each document with n_words, spans (runs of hit words; begin and end are UTF-8 byte offsets) and items.

    With a benchmark of several blocks the spans of different blocks may overlap.
    """
    spark = docs.sparkSession
    scratch.prepare(spark)
    tests = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(item_text).cast("string").alias("text"))
    chars = tests.agg(F.coalesce(F.sum(F.length("text") + F.lit(8)), F.lit(0)).alias("n")).first().n
    n_blocks = max(1, -(-chars // block_chars))
    got = docs.select(*[F.col(c).alias(f"__c{k}") for k, c in enumerate(columns)], F.col(text).cast("string").alias("__text"))
    base = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in got.schema.fields)
    for block in range(n_blocks):
        rows = tests if n_blocks == 1 else tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        share = spark.sparkContext.broadcast(build_windows([(r.item, r.text) for r in rows.toLocalIterator()], width))
        got = got.mapInArrow(_scanner(share, len(columns), block > 0), f"{base}, {_RESULT}")
        if block + 1 < n_blocks:
            got = scratch.table(got, "decontaminate")
    return got.select(*[F.col(f"__c{k}").alias(c) for k, c in enumerate(columns)], F.col("n_words"), F.col("spans"), F.col("items"), F.col("__text").alias("__text"))


def _hit_words(spans):
    """Words in the union of the spans (those of different blocks can overlap)."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.first_word.alias("a"), (s.first_word + s.n_words).alias("b"))))
    zero = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n"))
    return F.aggregate(ordered, zero, lambda z, s: F.struct(F.greatest(z.reach, s.b).alias("reach"), (z.n + F.greatest(s.b - F.greatest(s.a, z.reach), F.lit(0))).alias("n"))).n.cast("bigint")


def report(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", **how) -> DataFrame:
    """Per document: id, n_words, n_hit, items, spans."""
    got = scan(docs, benchmark, columns=[id], **how)
    return got.select(id, "n_words", _hit_words(F.col("spans")).alias("n_hit"), "items", "spans")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("__text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if spans:
                raw, reach, kept = text.encode(), 0, []
                for s in sorted(spans, key=lambda s: s["begin"]):
                    kept.append(raw[reach : max(reach, s["begin"])])
                    reach = max(reach, s["end"])
                text = b"".join([*kept, raw[reach:]]).decode()
            out.append(text)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, pa.string())], [*batch.schema.names[:-2], "__text"])


def remove(docs: DataFrame, benchmark: DataFrame, *, whole: bool = True, text: str = "text", **how) -> DataFrame:
    """`docs` (its own columns) without documents that hold a test window, or, if not `whole`, without the hit words."""
    names = [f"__k{k}" for k in range(len(docs.columns))]
    got = scan(docs.toDF(*names), benchmark, columns=names, text=names[docs.columns.index(text)], **how)
    if whole:
        return got.where(F.size("items") + F.size("spans") == 0).select(*names).toDF(*docs.columns)
    ordered = got.select(*names, "spans", "__text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields if f.name != "spans")
    cut = ordered.mapInArrow(_cut, schema)
    return cut.select(*[F.col("__text" if c == text else n).alias(c) for n, c in zip(names, docs.columns, strict=True)])

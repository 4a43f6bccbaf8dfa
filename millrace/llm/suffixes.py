"""Suffix-array dedup: repeated byte strings by distributed prefix doubling.

Bytes of a document that lie in a `LENGTH`-byte string which also starts anywhere else
are dropped.  Ranking every byte position would sort the corpus several times over, so
the positions that are doubled are content-defined: anchors, where the hash of `GRAM`
bytes is least among `REACH` neighbours.  Every stretch of REACH positions has one, and
equal strings have equal anchors but for REACH bytes at their ends.

1. Doubling.  A phrase (the bytes between two anchors) is named by its hash.  All names
   meet in slices of the name space, where they are sorted; a name that is unique there
   is dropped.  At level j the pair of names of (i, i + 2**(j-1)) names 2**j phrases and
   is sorted again; a document goes on until all its positions are unique or past the
   threshold (as many phrases as its strings and their surroundings can need).
2. Classes.  All strings with the same first inner anchor form a run of up to REACH
   starts.  A run is *inner* repeated if the phrases inside all its strings are, and
   *outer* repeated if the phrases that hold all its strings are, with the starts at the
   same places of them.  Both are named from two overlapping doubled ranks.  Not inner
   repeated: no string of the run repeats.  Outer repeated: all do.
3. Runs between the two (where a repeat begins or ends), and one of each kind of outer
   neighbour they have, compare their strings one by one, by 64-bit hash.
4. Marked starts cover their strings; what is not covered is kept.

Names and string hashes have 64 bits: n strings have n**2 / 2**65 false matches expected.

Defined cases.  Null and empty texts have no bytes; texts shorter than LENGTH keep all.
Every row is a place of its own, so repeated rows repeat one another, whatever their ids
(null or equal) are.  A cut can split a multi-byte character: `kept` is binary.  Empty
table: empty result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, slices
from millrace.llm import textkernel as K
from millrace.llm.substrings import _marked, _per_document

LENGTH = 400
GRAM, REACH = 16, 64


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width], for every i that has one; width is a power of two."""
    step = 1
    while step < width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return x


def anchors(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Anchor positions of a block, ascending; `first`: offsets of its rows in `data`."""
    wide = REACH + GRAM - 1
    if len(data) < wide:
        return np.empty(0, np.int64)
    h = K.window_hashes(K._BYTE[data], GRAM)
    least = _sliding(h, REACH, np.minimum)
    least[~K.windows_within(first, wide, len(data))] = 0
    around = np.concatenate((np.zeros(REACH - 1, np.uint64), least, np.zeros(REACH - 1, np.uint64)))
    return np.flatnonzero(_sliding(around, REACH, np.maximum) == h[: len(around) - REACH + 1])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return K.mix(a * np.uint64(0xD6E8FEB86659FD93) + K.mix(b ^ np.uint64(0xA0761D6478BD642F)))


def _names(base: np.ndarray, level: int) -> np.ndarray:
    """Names of 2**level phrases from each position that has as many."""
    for j in range(level):
        step = 1 << j
        if len(base) <= step:
            return np.empty(0, np.uint64)
        base = _pair(base[:-step], base[step:])
    return base


class _Runs:
    """Runs of starts of one document (see above); edges: 0, the anchors, the length."""

    def __init__(self, edges: np.ndarray):
        q, n = edges[1:-1], int(edges[-1])
        margin = REACH - 1
        self.low = np.maximum(np.concatenate(([0], q[:-1] - margin + 1)), 0)
        self.high = np.minimum(q - margin, n - LENGTH)
        self.run = np.flatnonzero(self.high >= self.low)
        self.low, self.high = self.low[self.run], self.high[self.run]
        self.inner = self.run + 1
        # Every string of the run starts 2 * margin before its first inner anchor at most: what all of them hold is the same wherever the run occurs.
        last = np.searchsorted(q, q[self.run] + LENGTH - GRAM - 3 * margin, "right") - 1
        self.n_inner = np.maximum(last - self.run, 0)
        self.outer = np.searchsorted(edges, self.low, "right") - 1
        self.n_outer = np.searchsorted(edges, self.high + LENGTH, "left") - self.outer
        self.places = (np.stack((self.low, self.high), axis=1) - edges[self.outer][:, None]).astype(np.int64)

    def spans(self, level: np.ndarray, start: np.ndarray, n: np.ndarray, upto: int | None) -> np.ndarray:
        """Whether the n phrases from start may be repeated, by the two ranks that span them (of levels up to `upto`)."""
        j = np.log2(np.maximum(n, 1)).astype(np.int64)
        j = j if upto is None else np.minimum(j, upto)
        inside = (start >= 0) & (start + n <= len(level))
        first, second = np.clip(start, 0, len(level) - 1), np.clip(start + n - (1 << j), 0, len(level) - 1)
        return inside & ((n == 0) | ((level[first] >= j) & (level[second] >= j)))

    def possible(self, level: np.ndarray, upto: int | None) -> np.ndarray:
        """Runs that may be inner repeated."""
        return self.spans(level, self.inner, self.n_inner, upto)

    def named(self, base: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), np.uint64)
        j = np.log2(np.maximum(n, 1)).astype(np.int64)
        for level in np.unique(j).tolist():
            names = _names(base, level)
            at = np.flatnonzero((j == level) & (n > 0))
            out[at] = _pair(_pair(names[start[at]], names[start[at] + n[at] - (1 << level)]), n[at].astype(np.uint64))
        return out


class _Blocks:
    """Numbers the blocks of a task: the same again when the task is run again."""

    def __init__(self):
        self.task, self.seen = TaskContext.get().partitionId(), 0

    def next(self, *content: np.ndarray) -> int:
        self.seen += 1
        return slices.block_id(np.array([self.task, self.seen]), *content)


def _lists(arrays: list[np.ndarray], kind) -> bytes:
    return np.array([len(a) for a in arrays], np.uint32).tobytes() + b"".join(a.astype(kind).tobytes() for a in arrays)


def _unlists(raw: bytes, n: int, kind) -> tuple[list[np.ndarray], bytes]:
    """n lists from the start of `raw`, and the rest of it."""
    size = np.frombuffer(raw, np.uint32, n).astype(np.int64)
    total = int(size.sum())
    end = 4 * n + total * np.dtype(kind).itemsize
    return np.split(np.frombuffer(raw[4 * n : end], kind), np.cumsum(size)[:-1]), raw[end:]


def _head(ids: np.ndarray, keys: np.ndarray) -> bytes:
    return ids.tobytes() + keys.tobytes()


def _unhead(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(raw, np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


_KEY = "id bigint, key bigint"
_STATE = f"{_KEY}, gaps binary, names binary, level binary, need int"


def _rows(schema: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), *[pa.int32() if name == "need" else pa.binary() for name in schema[2:]]]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], schema)


def _slice_kind(n_slices: int):
    return np.uint16 if n_slices <= 65536 else np.uint32


def _send_phrases(at: np.ndarray):
    """Level 0: the names of all phrases; the header has their gaps and slices."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _Blocks()
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = K.rows_of(batch.column(2))
            for i, j in K.blocks(offsets):
                own = offsets[i : j + 1] - offsets[i]
                raw = data[offsets[i] : offsets[j]]
                q = anchors(raw, own)
                prefix = K.prefix_hashes(K._BYTE[raw])
                gaps, names = [], []
                rows = np.flatnonzero(np.diff(own) >= LENGTH)
                for r in rows.tolist():
                    lo, hi = np.searchsorted(q, own[r : r + 2])
                    e = np.concatenate((own[r : r + 1], q[lo:hi], own[r + 1 : r + 2]))
                    names.append(K.span_hashes(prefix, e[:-1], e[1:]))
                    gaps.append(np.diff(e))
                if names:
                    h = np.concatenate(names)
                    row = np.repeat(np.arange(len(names)), [len(x) for x in names])
                    header = (_head(ids[i + rows], keys[i + rows]), _lists(gaps, np.uint32) + slices.slice_of(h, len(at)).astype(_slice_kind(len(at))).tobytes())
                    yield slices.pack(number.next(ids[i + rows], keys[i + rows]), at, row, len(names), h, 8, header)

    return send


def _repeated(names: bool):
    """Of each slice: bits of the entries that are not unique, and, if asked for, their hashes."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = slices.Gathered(batches, 8)
        bodies = []
        if got.parts:
            order, starts = got.ranked()
            size = np.diff(np.append(starts, len(order)))
            many = np.empty(len(order), bool)
            many[order] = np.repeat(size > 1, size)
            for (block, s, whose, _), a, b in zip(got.parts, got.edge[:-1].tolist(), got.edge[1:].tolist(), strict=True):
                own = many[a:b]
                if own.any():
                    bodies.append((block, s, whose, np.packbits(own).tobytes() + (got.hashes[a:b][own].tobytes() if names else b"")))
        yield got.answers(bodies)

    return reduce


def _bits(found: dict[int, tuple[bytes, bytes]], order: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Bits of a block's entries, from the answers by slice."""
    out = np.zeros(len(order), bool)
    for s, (_, body) in found.items():
        n = int(edge[s + 1] - edge[s])
        out[order[edge[s] : edge[s + 1]]] = np.unpackbits(np.frombuffer(body, np.uint8, -(-n // 8)), count=n)
    return out


def _first_level(n_slices: int):
    """State of each document with a run that may be repeated: gaps, names, level of each phrase (-1: unique)."""
    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, body, found in slices.blocks_of(batches):
            ids, keys = _unhead(head)
            gaps, rest = _unlists(body, len(ids), np.uint32)
            own = np.frombuffer(rest, _slice_kind(n_slices))
            order = np.argsort(own, kind="stable")
            edge = np.searchsorted(own[order], np.arange(n_slices + 1))
            many = _bits(found, order, edge)
            names = np.zeros(len(own), np.uint64)
            for s, (_, reply) in found.items():
                at = order[edge[s] : edge[s + 1]]
                names[at[many[at]]] = np.frombuffer(reply[-(-len(at) // 8) :], np.uint64)
            level = np.where(many, 0, -1).astype(np.int8)
            cut = np.cumsum([len(g) for g in gaps])[:-1]
            out = []
            for k, (g, x, y) in enumerate(zip(gaps, np.split(names, cut), np.split(level, cut), strict=True)):
                need = _need(_Runs(np.concatenate(([0], np.cumsum(g)))), y, 0)
                if need >= 0:
                    out.append((int(ids[k]), int(keys[k]), g.astype(np.uint32).tobytes(), x.tobytes(), y.tobytes(), need))
            if out:
                yield _rows(["id", "key", "gaps", "names", "level", "need"], out)

    return regroup


def _need(runs: _Runs, level: np.ndarray, upto: int) -> int:
    """Highest level that a document's runs can need; -1: none of them can be repeated."""
    at = runs.possible(level, upto)
    if not at.any():
        return -1
    outer = at & runs.spans(level, runs.outer, runs.n_outer, upto)
    return int(np.log2(max(1, int(runs.n_inner[at].max(initial=1)), int(runs.n_outer[outer].max(initial=1)))))


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for id, key, gaps, names, level in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
        yield id, key, np.frombuffer(gaps, np.uint32), np.frombuffer(names, np.uint64), np.frombuffer(level, np.int8)


def _grow(names: np.ndarray, level: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose run of 2**upto phrases may be repeated, and its names."""
    half = 1 << (upto - 1)
    if len(level) <= half:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero((level[:-half] >= upto - 1) & (level[half:] >= upto - 1))
    return at, _names(names, upto)[at] if len(at) else np.empty(0, np.uint64)


def _packed_state(chosen: list[tuple]) -> tuple[bytes, bytes]:
    ids, keys = np.array([c[0] for c in chosen], np.int64), np.array([c[1] for c in chosen], np.int64)
    return _head(ids, keys), b"".join(_lists([c[k] for c in chosen], kind) for k, kind in ((2, np.uint32), (3, np.uint64), (4, np.int8)))


def _unpacked_state(head: bytes, body: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    ids, keys = _unhead(head)
    parts = []
    for kind in (np.uint32, np.uint64, np.int8):
        lists, body = _unlists(body, len(ids), kind)
        parts.append(lists)
    yield from zip(ids.tolist(), keys.tolist(), *parts, strict=True)


#: Documents whose state travels as one block.
_TOGETHER = 256


def _send_state(at: np.ndarray, entries, more: bool):
    """entries: a document's state to the hashes it sends (and, with more, a second number of each)."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _Blocks()
        for batch in batches:
            rows = list(_documents(batch))
            for i in range(0, len(rows), _TOGETHER):
                chosen = rows[i : i + _TOGETHER]
                sent = [entries(*c[2:]) for c in chosen]
                row = np.repeat(np.arange(len(chosen)), [len(x[0]) for x in sent])
                h = np.concatenate([x[0] for x in sent])
                extra = np.concatenate([x[1] for x in sent]) if more else None
                ids = [np.array([c[k] for c in chosen], np.int64) for k in (0, 1)]
                yield slices.pack(number.next(*ids), at, row, len(chosen), h, 8, _packed_state(chosen), b"", extra)

    return send


def _next_level(n_slices: int, upto: int):
    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, body, found in slices.blocks_of(batches, quiet=True):
            out = []
            chosen = list(_unpacked_state(head, body))
            sent = [_grow(names, level, upto) for _, _, _, names, level in chosen]
            order, edge = slices.order_sent(np.concatenate([x[1] for x in sent]), n_slices)
            many = np.split(_bits(found, order, edge), np.cumsum([len(x[0]) for x in sent])[:-1])
            for (id, key, gaps, names, level), (at, _), own in zip(chosen, sent, many, strict=True):
                level = level.copy()
                level[at[own]] = upto
                need = _need(_Runs(np.concatenate(([0], np.cumsum(gaps)))), level, upto)
                if need >= 0:
                    out.append((id, key, gaps.tobytes(), names.tobytes(), level.tobytes(), need))
            if out:
                yield _rows(["id", "key", "gaps", "names", "level", "need"], out)

    return regroup


def _run_names(gaps: np.ndarray, names: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, _Runs, np.ndarray]:
    """Inner and outer names of the runs that may be repeated (outer 0: can't be), and which runs these are."""
    runs = _Runs(np.concatenate(([0], np.cumsum(gaps))))
    at = np.flatnonzero(runs.possible(level, None))
    inner = runs.named(names, runs.inner[at], runs.n_inner[at])
    whole = runs.spans(level, runs.outer[at], runs.n_outer[at], None)
    outer = np.zeros(len(at), np.uint64)
    # Periodic texts hold the same inner phrases at several places of equal outer ones: the places of the first and last start belong to the name.
    places = (runs.places[at][whole, 0] << 32) + runs.places[at][whole, 1]
    outer[whole] = _pair(runs.named(names, runs.outer[at][whole], runs.n_outer[at][whole]), places.astype(np.uint64))
    return inner, outer, runs, at


_SURE, _SHIP = 1, 2


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A code for each run: all its strings are repeated, and/or they have to be compared one by one."""
    got = slices.Gathered(batches, 8, more=True)
    bodies = []
    if got.parts:
        order = np.lexsort((got.more, got.hashes))
        inner, outer = got.hashes[order], got.more[order]
        new_in = np.concatenate(([True], inner[1:] != inner[:-1]))
        new_out = new_in | np.concatenate(([True], outer[1:] != outer[:-1]))
        group_in, group_out = np.cumsum(new_in) - 1, np.cumsum(new_out) - 1
        many_in = np.bincount(group_in)[group_in] > 1
        sure = (np.bincount(group_out)[group_out] > 1) & (outer != 0)
        open_ = many_in & ~sure
        partner = sure & new_out & (np.bincount(group_in, weights=open_)[group_in] > 0)
        code = np.empty(len(order), np.uint8)
        code[order] = sure * _SURE + (open_ | partner) * _SHIP
        for (block, s, whose, _), a, b in zip(got.parts, got.edge[:-1].tolist(), got.edge[1:].tolist(), strict=True):
            if code[a:b].any():
                bodies.append((block, s, whose, code[a:b].tobytes()))
    yield got.answers(bodies)


def _run_codes(n_slices: int):
    """(id, key, sure, open): starts of repeated strings, and of those to compare, as [low, high] pairs of int32."""
    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, body, found in slices.blocks_of(batches):
            chosen = list(_unpacked_state(head, body))
            sent = [_run_names(*c[2:]) for c in chosen]
            order, edge = slices.order_sent(np.concatenate([x[0] for x in sent]), n_slices)
            code = np.zeros(len(order), np.uint8)
            for s, (_, reply) in found.items():
                code[order[edge[s] : edge[s + 1]]] = np.frombuffer(reply, np.uint8)
            out = []
            for (id, key, *_), (_, _, runs, at), own in zip(chosen, sent, np.split(code, np.cumsum([len(x[3]) for x in sent])[:-1]), strict=True):
                if own.any():
                    both = np.stack((runs.low[at], runs.high[at]), axis=1).astype(np.int32)
                    out.append((id, key, both[(own & _SURE) > 0].tobytes(), both[(own & _SHIP) > 0].tobytes()))
            if out:
                yield _rows(["id", "key", "sure", "open"], out)

    return regroup


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, lists of sure and of open) of repeated rows to their unions: any one of them may be another's partner."""
    for batch in batches:
        rows = []
        for id, key, *both in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs = [np.unique(np.frombuffer(b"".join(x), np.int32).reshape(-1, 2), axis=0) if len(x) > 1 else x[0] for x in both]
            rows.append((id, key, *[p if isinstance(p, bytes) else p.tobytes() for p in pairs]))
        yield _rows(["id", "key", "sure", "open"], rows)


def _starts(pairs: bytes) -> np.ndarray:
    p = np.frombuffer(pairs, np.int32).reshape(-1, 2).astype(np.int64)
    n = p[:, 1] - p[:, 0] + 1
    return np.repeat(p[:, 0] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum())) if len(p) else np.empty(0, np.int64)


def _string_hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return K.span_hashes(K.prefix_hashes(K._BYTE[raw]), starts, starts + LENGTH)


def _send_strings(at: np.ndarray):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _Blocks()
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = K.rows_of(batch.column(2))
            spans = batch.column(3).to_pylist()
            for i, j in K.blocks(offsets):
                h = [_string_hashes(data[offsets[k] : offsets[k + 1]], _starts(spans[k])) for k in range(i, j)]
                row = np.repeat(np.arange(j - i), [len(x) for x in h])
                own = (ids[i:j].tobytes(), keys[i:j].tobytes())
                yield slices.pack(number.next(ids[i:j], keys[i:j]), at, row, j - i, np.concatenate(h), 8, own)

    return send


def _cut(n_slices: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.rows_of(batch.column(1))
            sure, opened, bits = (batch.column(k).to_pylist() for k in (2, 3, 4))
            lengths, spans, kept = [], [], []
            for k in range(len(batch)):
                raw = data[offsets[k] : offsets[k + 1]]
                lengths.append(len(raw))
                if sure[k] is None:
                    spans.append([])
                    kept.append(raw.tobytes())
                    continue
                edge = np.zeros(len(raw) + 1, np.int32)
                both = np.frombuffer(sure[k], np.int32).reshape(-1, 2)
                np.add.at(edge, both[:, 0], 1)
                np.add.at(edge, both[:, 1] + LENGTH, -1)
                if bits[k]:
                    starts = _starts(opened[k])
                    starts = starts[_marked(bits[k], _string_hashes(raw, starts), n_slices)]
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                step = np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))
                spans.append([{"begin": a, "end": b} for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)])
                kept.append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], ["id", "n_bytes", "removed", "kept"])

    return cut


def dedup(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_bytes, removed (maximal byte runs [begin, end)) and kept (bytes left)."""
    spark = docs.sparkSession
    scratch.prepare(spark)
    n, at = scratch.partitions(spark), slices.labels(spark)
    rows = docs.select(F.col(id).alias("own"), F.xxhash64(F.col(id).cast("string")).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("key"), F.col(text).cast("string").alias("text"))
    texts = rows.select("id", "key", "text")
    state = scratch.table(slices.exchange(texts, _send_phrases(at), _repeated(names=True), _first_level(n), _STATE), "phrases")
    done, level = [], 0
    while True:
        # Documents whose runs need no more phrases are past the threshold and wait.
        level += 1
        done.append(state.where(F.col("need") < level))
        active = state.where(F.col("need") >= level)
        if active.isEmpty():
            break
        grow = (lambda upto: lambda gaps, names, known: (_grow(names, known, upto)[1],))(level)
        state = scratch.table(slices.exchange(active, _send_state(at, grow, more=False), _repeated(names=False), _next_level(n, level), _STATE), "phrases")
    state = done[0]
    for more in done[1:]:
        state = state.union(more)
    runs = slices.exchange(state, _send_state(at, lambda *s: _run_names(*s)[:2], more=True), _classes, _run_codes(n), f"{_KEY}, sure binary, open binary")
    runs = runs.groupBy("id", "key").agg(F.collect_set("sure").alias("sure"), F.collect_set("open").alias("open")).mapInArrow(_merged, f"{_KEY}, sure binary, open binary")
    runs = scratch.table(runs, "runs")
    # Both joins take the same columns of the rows, so the texts are shuffled once.
    compare = rows.join(runs.where(F.length("open") > 0).select("id", "key", "open"), ["id", "key"]).select("id", "key", "text", "open", "own")
    marks = slices.exchange(compare, _send_strings(at), _repeated(names=False), _per_document, f"{_KEY}, bits binary")
    marks = runs.join(marks.groupBy("id", "key").agg(F.first("bits").alias("bits")), ["id", "key"], "left")
    joined = rows.join(marks, ["id", "key"], "left").select("own", "text", "sure", "open", "bits")
    kind = docs.schema[id].dataType.simpleString()
    got = joined.mapInArrow(_cut(n), f"id {kind}, n_bytes bigint, removed array<struct<begin:bigint,end:bigint>>, kept binary")
    return got.select(F.col("id").alias(id), "n_bytes", "removed", "kept")

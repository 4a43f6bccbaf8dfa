"""Language-model scoring with a log-frequency Bloom filter.

Training counts are gathered exactly and everywhere in Spark: tokens (words, A-Z
lower-cased, and one END a text) with their counts, and bigrams of adjacent tokens, END
standing before a text's first.  A bigram of count c goes into a Bloom filter once for
each level up to 1 + floor(log2 c); its quantised count is read back by probing level
after level until one is missing, and is the level's lower end, so it is never too high
but by false positives (about 0.1 % a probe).  Every slice of the hash space has a filter
of its own, sized by what it holds.

    p(w | h) = (1 - L) * min(q(hw), c(h), c(w)) / c(h) + L * p(w)
    p(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))

N tokens, V distinct; L depends on log2 c(h) and is fitted by deleted estimation: over all
training texts, each bigram scored with its own occurrence taken out.  A token that never
led a training bigram has L = 1.  Probabilities sum to 1 at most.

The texts are scanned once for fit and scores: a text keeps, for each level of c(h) it has,
its sum of log10 p at every weight of the grid, and the fitted weights choose among them.

Vocabulary and filter are broadcast.  They grow with the corpus, so their size is known
and checked before they are fetched: beyond `SHARE_BYTES` they are split by slices into
shards below that size, and the texts are scanned once a shard, collecting their tokens'
counts, with the same result.

Defined cases.  Null or blank texts have one token, END.  A null id is hashed as an empty
string.  Rows are scored one by one, so repeated rows and ids are fine (a repeated
training row trains twice).  No training rows: N = V = 0 and all tokens have p = 1.
Empty table: empty result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, slices
from millrace.llm import textkernel as K

END = np.uint64(0xE5D0E5D0E5D0E5D1)
BITS, PROBES = 16, 8
SHARE_BYTES = 256_000_000
#: Tokens of a task that are counted together before they are sent.
CHUNK = 2_000_000
GRID = np.array([1.0, 0.98, 0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05])
LEVELS = 48
_TOKEN, _BIGRAM = 0, 1


def held_out(id: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a block's tokens (words, then END, by row), of the bigrams that end in them, and each row's first token."""
    w = K.words_of(data, offsets, K.BLANK, lower=True)
    n = np.diff(w.first) + 1
    first = np.concatenate(([0], np.cumsum(n)))
    h = np.full(int(first[-1]), END, np.uint64)
    h[np.arange(len(w.hash)) + w.row()] = w.hash
    before = np.concatenate(([END], h[:-1]))  # a row's first token follows END: the row before ends with it
    return h, K.mix(before * np.uint64(0x9E3779B97F4A7C15) + K.mix(h)), first


_PACKED = "label int, kind int, slice int, single binary, many binary, counts binary"


def _send(at: np.ndarray):
    """(training, text) to distinct hashes by slice, those seen once without a count."""
    n = len(at)

    def flush(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for kind, parts in held.items():
            h, c = np.unique(np.concatenate(parts), return_counts=True)
            edge = np.searchsorted(slices.slice_of(h, n), np.arange(n + 1))
            rows = [(at[s], kind, s, h[a:b][c[a:b] == 1].tobytes(), h[a:b][c[a:b] > 1].tobytes(), c[a:b][c[a:b] > 1].astype(np.int64).tobytes()) for s, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if b > a]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["label", "kind", "slice", "single", "many", "counts"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {_TOKEN: [], _BIGRAM: []}
        size = 0
        for batch in batches:
            data, offsets = K.rows_of(batch.column(0))
            for i, j in K.blocks(offsets):
                h, two, _ = tokens(data, offsets[i : j + 1])
                held[_TOKEN].append(h)
                held[_BIGRAM].append(two)
                size += len(h)
                if size >= CHUNK:
                    yield from flush(held)
                    held, size = {_TOKEN: [], _BIGRAM: []}, 0
        if size:
            yield from flush(held)

    return send


def level_of(counts: np.ndarray) -> np.ndarray:
    """Levels that a count fills: 1 + floor(log2)."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def _items(h: np.ndarray, level) -> np.ndarray:
    return K.mix(h ^ np.uint64(level * 0xA0761D6478BD642F & (1 << 64) - 1))


def _place(item: np.ndarray, k: int, n_bits: np.ndarray | int) -> np.ndarray:
    step = K.mix(item + np.uint64(0x8EBC6AF09C88C6E3)) | np.uint64(1)
    return ((item + np.uint64(k) * step) % np.asarray(n_bits, np.uint64)).astype(np.int64)


def build_filter(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bytes of a filter that holds each hash once for each of its levels."""
    level = level_of(counts)
    n_bits = max(64, int(level.sum()) * BITS)
    n_bits += -n_bits % 8
    bits = np.zeros(n_bits, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        item = _items(h[level >= j], j)
        for k in range(PROBES):
            bits[_place(item, k, n_bits)] = True
    return np.packbits(bits, bitorder="little")


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's slices to (slice, tokens, counts, filter, n, v, bytes)."""
    parts: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for kind, s, single, many, counts in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
            one = np.frombuffer(single, np.uint64)
            parts.setdefault((s, kind), []).append((np.concatenate((one, np.frombuffer(many, np.uint64))), np.concatenate((np.ones(len(one), np.int64), np.frombuffer(counts, np.int64)))))
    for s in sorted({s for s, _ in parts}):
        found = []
        for kind in (_TOKEN, _BIGRAM):
            got = parts.pop((s, kind), [])
            h = np.concatenate([x for x, _ in got]) if got else np.empty(0, np.uint64)
            c = np.concatenate([y for _, y in got]) if got else np.empty(0, np.int64)
            order = np.argsort(h, kind="stable")
            h, c = h[order], c[order]
            start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
            found.append((h[start], np.add.reduceat(c, start) if len(h) else c))
        (h, c), (h2, c2) = found
        bits = build_filter(h2, c2)
        row = (s, h.tobytes(), c.tobytes(), bits.tobytes(), int(c.sum()), len(h), 16 * len(h) + len(bits))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], ["slice", "tokens", "counts", "filter", "n", "v", "bytes"])


@dataclass
class Shard:
    """Slices [low, high) of the vocabulary and the filters."""

    n_slices: int
    low: int
    high: int
    tokens: np.ndarray
    counts: np.ndarray
    filters: np.ndarray
    first_bit: np.ndarray
    n_bits: np.ndarray

    def mine(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = slices.slice_of(h, self.n_slices)
        return np.flatnonzero((s >= self.low) & (s < self.high)), s

    def count(self, h: np.ndarray, out: np.ndarray) -> None:
        """Exact counts of tokens of this shard."""
        at, _ = self.mine(h)
        if len(self.tokens):
            near = np.minimum(np.searchsorted(self.tokens, h[at]), len(self.tokens) - 1)
            out[at] = np.where(self.tokens[near] == h[at], self.counts[near], 0)

    def quantised(self, h: np.ndarray, out: np.ndarray) -> None:
        """Levels of bigrams of this shard, by repeated membership probes."""
        at, s = self.mine(h)
        at = at[self.n_bits[s[at] - self.low] > 0]
        # A text says many bigrams more than once: each is looked up once
        _, first, back = np.unique(h[at], return_index=True, return_inverse=True)
        whole, at = at, at[first]
        level = 0
        while len(at):
            level += 1
            own = s[at] - self.low
            item = _items(h[at], level)
            for k in range(PROBES):
                place = _place(item, k, self.n_bits[own]) + self.first_bit[own]
                hit = (self.filters[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                at, own, item = at[hit], own[hit], item[hit]
            out[at] = level
        out[whole] = out[whole[first]][back]


def _shard(rows, n_slices: int, low: int, high: int) -> Shard:
    by = {r.slice: r for r in rows}
    parts = [by.get(s) for s in range(low, high)]
    join = lambda k, t: np.frombuffer(b"".join([getattr(p, k) for p in parts if p]), t)
    size = np.array([len(p.filter) if p else 0 for p in parts], np.int64)
    return Shard(n_slices, low, high, join("tokens", np.uint64), join("counts", np.int64), join("filter", np.uint8), np.concatenate(([0], np.cumsum(size)[:-1])) * 8, size * 8)


def mixture(mixed, pair: np.ndarray, alone: np.ndarray) -> np.ndarray:
    return (1 - mixed) * pair + mixed * alone


@dataclass
class Model:
    n: int
    v: int
    mixed: np.ndarray

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return (c + 0.5) / (self.n + 0.5 * (self.v + 1))

    def parts(self, c: np.ndarray, before: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: its bigram's count as read back, the level of its context, and p(w)."""
        pair = np.minimum(np.where(level > 0, np.exp2(level - 1.0), 0), np.minimum(c, before))
        return pair, np.minimum(level_of(before), LEVELS - 1), self.unigram(c)

    def probability(self, c: np.ndarray, before: np.ndarray, level: np.ndarray) -> np.ndarray:
        pair, own, alone = self.parts(c, before, level)
        return mixture(self.mixed[own], pair / np.maximum(before, 1), alone)



def _lookup(share):
    """Each block's (tokens, counts, counts before, levels, first): of one shard, or of all that came before with it."""
    def lookup(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        shard = share.value
        at = batch.schema.get_field_index
        data, offsets = K.rows_of(batch.column(at("text")))
        counts, levels = batch.column(at("counts")).to_pylist(), batch.column(at("levels")).to_pylist()
        for i, j in K.blocks(offsets):
            h, two, first = tokens(data, offsets[i : j + 1])
            if counts[i] is None:
                c, level = np.zeros(len(h), np.int64), np.zeros(len(h), np.uint8)
            else:
                c, level = np.frombuffer(b"".join(counts[i:j]), np.int64).copy(), np.frombuffer(b"".join(levels[i:j]), np.uint8).copy()
            shard.count(h, c)
            shard.quantised(two, level)
            yield i, j, first, c, level

    return lookup


def _before(c: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """Counts of the tokens before; `end`: of END, which stands before a row's first."""
    out = np.concatenate(([end], c[:-1]))
    out[first[:-1]] = end
    return out


def _collect(share):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _lookup(share)
        for batch in batches:
            counts, levels = [], []
            for _, _, first, c, level in look(batch):
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    counts.append(c[a:b].tobytes())
                    levels.append(level[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.binary()), pa.array(levels, pa.binary())], batch.schema.names)

    return collect


def _sums(share, model: Model, end: int):
    """Everything a score needs, in one scan: n_tokens, n_known, base_score, and for each level of c(h) that a text has its sum of log10 p at every weight of the grid.

    Training texts also add to the log-likelihood of their bigrams with their own
    occurrence taken out; a task gives these totals once, on a row of its own (level null
    there: `levels` holds nothing and `parts` all LEVELS x GRID sums).
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _lookup(share)
        left_out = np.zeros((LEVELS, len(GRID)))
        names = ["id", "held_out", "n_tokens", "n_known", "base_score", "levels", "parts"]
        kinds = None
        for batch in batches:
            trains = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            numbers: list[list[np.ndarray]] = [[], [], []]
            levels, parts = [], []
            for i, j, first, c, level in look(batch):
                at, n = first[:-1], np.diff(first)
                row = np.repeat(np.arange(j - i), n)
                before = _before(c, first, end)
                pair, own, alone = model.parts(c, before, level)
                for x, y in zip(numbers, (n, np.add.reduceat((c > 0).astype(np.int64), at), np.add.reduceat(np.log10(alone), at)), strict=True):
                    x.append(y)
                cells, cell = np.unique(row * LEVELS + own, return_inverse=True)
                told = np.empty((len(cells), len(GRID)))
                share_of = pair / np.maximum(before, 1)
                for k, mixed in enumerate(GRID.tolist()):
                    told[:, k] = np.bincount(cell, weights=np.log10(mixture(mixed, share_of, alone)), minlength=len(cells))
                edge = np.searchsorted(cells, np.arange(j - i + 1) * LEVELS)
                for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    levels.append((cells[x:y] % LEVELS).astype(np.uint8).tobytes())
                    parts.append(told[x:y].tobytes())
                mine = trains[i:j][row]
                if mine.any():
                    rest = np.maximum(pair[mine] - 1, 0) / np.maximum(before[mine] - 1, 1)
                    other = model.unigram(np.maximum(c[mine] - 1, 0))
                    for k, mixed in enumerate(GRID.tolist()):
                        left_out[:, k] += np.bincount(own[mine], weights=np.log(mixture(mixed, rest, other)), minlength=LEVELS)
            kinds = (batch.schema.types[0], pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary())
            out = [np.concatenate(x) if x else [] for x in numbers]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(x, t) for x, t in zip((*out, levels, parts), kinds[2:], strict=True)]], names)
        if kinds:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((None, None, None, None, None, None, left_out.tobytes()), kinds, strict=True)], names)

    return sums


def _weigh(mixed: np.ndarray):
    """Rows of `_sums` to their scores: of each level the sum at its weight."""
    chosen = np.searchsorted(-GRID, -mixed)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for levels, parts in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
                own = np.frombuffer(levels, np.uint8)
                scores.append(float(np.frombuffer(parts, np.float64).reshape(-1, len(GRID))[np.arange(len(own)), chosen[own]].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(scores, pa.float64())], [*batch.schema.names[:5], "score"])

    return weigh


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LEVELS * len(GRID))
    for batch in batches:
        for x in batch.column(0).to_pylist():
            total += np.frombuffer(x, np.float64)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["parts"])


def score(docs: DataFrame, *, id: str = "doc_id", text: str = "text", out: Column | None = None, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10); out: which rows do not train (a fifth of the ids unless given)."""
    spark = docs.sparkSession
    scratch.prepare(spark)
    n_slices, at = scratch.partitions(spark), slices.labels(spark)
    rows = docs.select(F.col(id).alias("id"), (held_out(F.col(id)) if out is None else out).alias("held_out"), F.col(text).cast("string").alias("text"))
    built = rows.where(~F.col("held_out")).select("text").mapInArrow(_send(at), _PACKED).repartition(n_slices, "label").mapInArrow(_build, "slice int, tokens binary, counts binary, filter binary, n bigint, v bigint, bytes bigint")
    built = scratch.table(built, "ngrams")
    sizes = built.select("slice", "n", "v", "bytes").collect()
    model = Model(sum(r.n for r in sizes), sum(r.v for r in sizes), np.ones(LEVELS))
    cuts, total = [0], 0
    for r in sorted(sizes, key=lambda r: r.slice):
        if total + r.bytes > share_bytes and total:
            cuts.append(r.slice)
            total = 0
        total += r.bytes
    cuts.append(n_slices)
    home = int(slices.slice_of(np.array([END]), n_slices)[0])
    end = 0
    for r in built.where(F.col("slice") == home).select("tokens", "counts").collect():
        found = np.flatnonzero(np.frombuffer(r.tokens, np.uint64) == END)
        end = int(np.frombuffer(r.counts, np.int64)[found[0]]) if len(found) else 0
    kind = rows.schema["id"].dataType.simpleString()
    texts = rows.withColumns({"counts": F.lit(None).cast("binary"), "levels": F.lit(None).cast("binary")})
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        got = built.where((F.col("slice") >= low) & (F.col("slice") < high)).toLocalIterator()
        share = spark.sparkContext.broadcast(_shard(got, n_slices, low, high))
        if high < n_slices:
            texts = scratch.table(texts.mapInArrow(_collect(share), f"id {kind}, held_out boolean, text string, counts binary, levels binary"), "counts")
    told = scratch.table(texts.mapInArrow(_sums(share, model, end), f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, levels binary, parts binary"), "sums")
    best = np.zeros((LEVELS, len(GRID)))
    # A row of 5 kB for each task of the scan, added up by shuffle partitions first
    for r in told.where("levels is null").select("parts").repartition(min(n_slices, 64)).mapInArrow(_added, "parts binary").collect():
        best += np.frombuffer(r.parts, np.float64).reshape(best.shape)
    mixed = GRID[np.argmax(best, axis=1)]
    mixed[:2] = 1.0  # contexts never seen, or once: nothing is left of them without the occurrence itself
    scored = told.where("levels is not null").mapInArrow(_weigh(mixed), f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select(F.col("id").alias(id), "held_out", "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"), "base_score", "score")

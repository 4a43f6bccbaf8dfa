"""N-gram Jaccard join: a size-aware heavy-light join, and the groups its links make.

A document's set holds the distinct shingles of `SHINGLE` words (blank-separated, A-Z
lower-cased); a text of fewer words is one shingle.  Sets link when their Jaccard
similarity is at least 3/4, so a set of n shares at least ceil(3n/4) shingles with any
partner.

1. Frequencies.  All sets' shingles meet by hash (``slices``) and each set gets back the
   shingles that other sets hold too, with their document frequencies.  A set in which
   fewer than 3/4 of the shingles are held by others cannot link and drops out.  Equal
   sets go on as one, by a 128-bit set hash.
2. Light sets (size up to a boundary) list their fixed-size subsets: two light sets that
   link, the larger of size b, share a subset of ceil(3b/4) shingles.
   Heavy sets post their rarest n - ceil(3n/4) + 1 shingles to inverted lists, light ones
   near the boundary too, and the lists are scanned.  The boundary is the size up to
   which listing subsets costs no more than scanning lists, both measured on the sets.
3. A list links its members to its least member; these candidate pairs are verified on
   the whole sets, and the links' components found.
4. Lists that still hold several components, their least member left out, are compared in
   full.  Members that have a possible partner by sizes and places bring their shingles
   along, so a list's task verifies its pairs itself, each pair in the list
   where the two sets first meet, and gives a spanning forest of the links between
   different components: fewer rows than the list has members, however many pairs link.
   Members of a list's biggest component are compared only with those outside it.  Lists
   of over `BLOCK` shingles are dealt out in blocks.  No link between different sets is
   lost.

Sets hold the high 48 bits of shingle hashes: a false match inside one pair of sets of
1000 has a chance of 4e-9.

Defined cases.  Null, empty or blank texts have no shingles and link with nothing, each
its own component.  Components are of texts, so rows with equal or null ids are fine; the
component id is the least non-null id in it.  Repeated rows link with each other.  Empty
table: empty result.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, slices
from millrace.llm import textkernel as K
from millrace.llm.components import components

SHINGLE = 5
#: Shingles of a list's members that are compared in one task; larger lists are cut to blocks of so many.
BLOCK = 1 << 20
#: Lists of at most so many members are looked through for possible partners before their sets are fetched; larger ones are compared in any case.
WALKED = 4096
#: Largest size for which listing subsets is considered at all.
LIGHT_MOST = 24
_BYTES = 6
_LIGHT_KEY = 1 << 62


def shared_least(n: int) -> int:
    """Shingles that a set of n shares with any partner, at least: ceil(3n/4)."""
    return -(-3 * n // 4)


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a block's rows, their rows (ascending), and set hashes (rows x 2)."""
    w = K.words_of(data, offsets, K.BLANK, lower=True)
    h = K.window_hashes(w.hash, SHINGLE)
    at = np.flatnonzero(K.windows_within(w.first, SHINGLE, len(w.hash)))
    row = np.searchsorted(w.first, at, "right") - 1
    h = h[at]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        extra = np.array([K.window_hashes(w.hash[w.first[r] : w.first[r + 1]], int(count[r]))[0] for r in short.tolist()], np.uint64)
        h, row = np.concatenate((h, extra)), np.concatenate((row, short))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        keep = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
        h, row = h[keep], row[keep]
    n = len(offsets) - 1
    sums = np.zeros((n, 2), np.uint64)
    if len(h):
        start = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            sums[row[start], k] = np.add.reduceat(K.mix(h ^ np.uint64(salt)), start)
    return h, row, sums


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, text) to (id, key, n, sid) of every row."""
    for batch in batches:
        data, offsets = K.rows_of(batch.column(2))
        n, sid = [], []
        for i, j in K.blocks(offsets):
            _, row, sums = _sets(data, offsets[i : j + 1])
            count = np.bincount(row, minlength=j - i).tolist()
            n += count
            sid += [s.tobytes() if c else None for s, c in zip(sums, count, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n, pa.int64()), pa.array(sid, pa.binary())], ["id", "key", "n", "sid"])


def _send(at: np.ndarray):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.rows_of(batch.column(0))
            for i, j in K.blocks(offsets):
                h, row, sums = _sets(data, offsets[i : j + 1])
                if len(h):
                    n = np.bincount(row, minlength=j - i).astype(np.uint32)
                    yield slices.pack(slices.block_id(sums[:, 0].view(np.int64), sums[:, 1].view(np.int64)), at, row, j - i, h, _BYTES, (n.tobytes(), sums.tobytes()))

    return send


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles that more than one row holds, with how many (65535 at most, for the order only)."""
    got = slices.Gathered(batches, _BYTES)
    bodies = []
    if got.parts:
        order, starts = got.ranked()
        size = np.diff(np.append(starts, len(order)))
        df = np.empty(len(order), np.uint16)
        df[order] = np.repeat(np.minimum(size, 65535), size)
        for (block, s, whose, _), a, b in zip(got.parts, got.edge[:-1].tolist(), got.edge[1:].tolist(), strict=True):
            many = df[a:b] > 1
            if many.any():
                row = slices.owners(whose)[many]
                bodies.append((block, s, slices.pack_owners(row, int(row[-1]) + 1), slices.narrow(got.hashes[a:b][many], _BYTES) + df[a:b][many].tobytes()))
    yield got.answers(bodies)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, n, held, load): sets of which others hold 3/4; held: those shingles, rarest first; load: length of the lists they would be posted to."""
    seen: set[bytes] = set()
    for counts, sums, found in slices.blocks_of(batches):
        n = np.frombuffer(counts, np.uint32).astype(np.int64)
        rows, hashes, dfs = [], [], []
        for whose, body in found.values():
            rows.append(slices.owners(whose))
            k = len(rows[-1])
            hashes.append(slices.widen(body[: k * _BYTES], _BYTES))
            dfs.append(np.frombuffer(body, np.uint16, k, k * _BYTES))
        row, h, df = np.concatenate(rows), np.concatenate(hashes), np.concatenate(dfs)
        order = np.lexsort((h, df, row))
        row, h, df = row[order], h[order], df[order]
        held = np.bincount(row, minlength=len(n))
        edge = np.concatenate(([0], np.cumsum(held)))
        out = []
        for r in np.flatnonzero(4 * held >= 3 * np.maximum(n, 1)).tolist():
            sid = sums[16 * r : 16 * r + 16]
            if sid not in seen:
                seen.add(sid)
                posted = max(0, int(n[r]) - shared_least(int(n[r])) + 1 - int(n[r] - held[r]))
                out.append((sid, int(n[r]), slices.narrow(h[edge[r] : edge[r + 1]], _BYTES), int(df[edge[r] : edge[r] + posted].sum())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.binary(), pa.int32(), pa.binary(), pa.int64()))], ["sid", "n", "held", "load"])


def light_cost(n: int, most: int) -> int:
    """Subsets that a light set of n lists, when sizes up to `most` are light."""
    return sum(math.comb(n, shared_least(b)) for b in range(n, min(most, 4 * n // 3) + 1) if shared_least(b) <= n)


def boundary(loads: dict[int, float]) -> int:
    """Largest size up to which listing subsets costs no more than scanning lists; loads: mean list entries to scan, by size."""
    light = 0
    for n in range(1, LIGHT_MOST + 1):
        if n in loads and light_cost(n, LIGHT_MOST) > max(1.0, loads[n]):
            break
        light = n
    return min(light, max(loads, default=0))


def _post(most: int):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner, places = [], [], []
            for at, (n, held) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                h = slices.widen(held, _BYTES)
                if n <= most:
                    ordered = np.sort(h).tolist()
                    for b in range(n, min(most, 4 * n // 3) + 1):
                        for chosen in combinations(ordered, shared_least(b)):
                            keys.append(_LIGHT_KEY | (int(K.mix(np.array([hash((b, *chosen)) & K._MASK64], np.uint64))[0]) >> 2))
                            owner.append(at)
                            places.append(0)
                if n > most or 4 * n >= 3 * (most + 1):
                    posted = max(0, n - shared_least(n) + 1 - (n - len(h)))
                    keys += (h[:posted] >> np.uint64(16)).tolist()
                    owner += [at] * posted
                    places += range(n - len(h), n - len(h) + posted)
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0).take(take), batch.column(1).take(take), pa.array(places, pa.int32())], ["key", "sid", "n", "place"])

    return post


def may_link(na, pa_, nb, pb):
    """Whether sets of sizes na, nb that meet at places pa, pb of their orders, and not before, can share enough."""
    return (4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)) & (7 * np.minimum(na - pa_, nb - pb) >= 3 * (na + nb))


def _partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lists (key, members, sid, label, big, n, place), sorted by key, the members that have a partner by size and place in another component."""
    def flush(rows):
        number: dict = {}
        comp = np.array([number.setdefault(r[3], len(number)) for r in rows])
        n, place = (np.array([r[k] for r in rows], np.int64) for k in (5, 6))
        fine = np.zeros(len(rows), bool)
        for i in np.flatnonzero([not r[4] for r in rows]).tolist():
            may = (comp != comp[i]) & may_link(n[i], place[i], n, place)
            if may.any():
                fine |= may
                fine[i] = True
        return [r for r, f in zip(rows, fine.tolist(), strict=True) if f]

    now, rows = None, []
    for batch in batches:
        kept = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and now != row[0]:
                kept += flush(rows)
                rows = []
            now = row[0]
            rows.append(row)
        schema = batch.schema
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in kept], f.type) for k, f in enumerate(schema)], schema=schema)
    if rows:
        kept = flush(rows)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in kept], f.type) for k, f in enumerate(schema)], schema=schema)


class _Members:
    """Members (sid, label, big, n, place, side, held) of a list, with an index from their shingles to them."""

    def __init__(self, rows: list[tuple]):
        self.sid = [r[0] for r in rows]
        number: dict = {}
        self.comp = np.array([number.setdefault(r[1], len(number)) for r in rows])
        self.big = np.array([r[2] for r in rows], bool)
        self.n, self.place, self.side = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5))
        held = [slices.widen(r[6], _BYTES) for r in rows]
        count = np.array([len(h) for h in held], np.int64)
        self.edge = np.concatenate(([0], np.cumsum(count)))
        _, self.code = np.unique(np.concatenate(held), return_inverse=True)
        order = np.argsort(self.code, kind="stable")
        self.member = np.repeat(np.arange(len(rows)), count)[order]
        self.first = np.searchsorted(self.code[order], np.arange(int(self.code.max(initial=-1)) + 2))
        # The shingles that no other set holds come first in a set's order, and are not in `held`.
        self.before = np.clip(self.place - (self.n - count), 0, count)

    def sharing(self, i: int, upto: int | None = None) -> np.ndarray:
        """Of each member, how many of i's first `upto` shingles (of all) it holds."""
        c = self.code[self.edge[i] : self.edge[i + 1]][:upto]
        begin, size = self.first[c], self.first[c + 1] - self.first[c]
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum())) if len(c) else np.empty(0, np.int64)
        return np.bincount(self.member[at], minlength=len(self.sid))


def _list_links(rows: list[tuple], apart: bool, light: bool) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between different components of a list's members.

    Pairs are compared where they first meet only (lists of subsets, which are small
    sets', compare all); apart: only pairs of different sides.  Two members of the
    list's biggest component need no comparison, so it is never walked.
    """
    m, out = _Members(rows), []
    for i in np.flatnonzero(~m.big).tolist():
        may = (m.comp != m.comp[i]) & may_link(m.n[i], m.place[i], m.n, m.place)
        if apart:
            may &= m.side != m.side[i]
        if not light and may.any():
            may &= m.sharing(i, int(m.before[i])) == 0
        if not may.any():
            continue
        both = m.sharing(i)
        linked = np.flatnonzero(may & (100 * both >= 75 * (m.n[i] + m.n - both)))
        comps, first = np.unique(m.comp[linked], return_index=True)
        if len(comps):
            out += [(m.sid[i], m.sid[x]) for x in linked[first].tolist()]
            m.comp[np.isin(m.comp, comps)] = m.comp[i]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, low, high, sid, label, big, n, place, side, held), sorted by the first three, to links (a, b)."""
    def flush(now, rows):
        links = _list_links(rows, now[1] != now[2], now[0] >= _LIGHT_KEY)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])

    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != row[:3]:
                if len(rows) > 1:
                    yield flush(now, rows)
                now, rows = row[:3], []
            rows.append(row[3:])
    if len(rows) > 1:
        yield flush(now, rows)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, na, nb, ha, hb) to (a, b, ok), on the whole sets."""
    for batch in batches:
        ok = []
        for na, nb, ha, hb in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True):
            both = len(np.intersect1d(slices.widen(ha, _BYTES), slices.widen(hb, _BYTES), assume_unique=True))
            ok.append(100 * both >= 75 * (na + nb - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "ok"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias("n" + x), F.col("held").alias("h" + x))
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ha", "hb")
    return scratch.table(both.mapInArrow(_verify, "a binary, b binary, ok boolean"), "verified")


def _lists(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Sets that may link, and their postings in lists of two or more."""
    spark = docs.sparkSession
    found = slices.exchange(docs.select(F.col(text).cast("string").alias("text")), _send(slices.labels(spark)), _frequencies, _candidates, "sid binary, n int, held binary, load bigint")
    sets = scratch.table(found.dropDuplicates(["sid"]), "sets")
    loads = {r.n: r.load for r in sets.where(F.col("n") <= LIGHT_MOST).groupBy("n").agg(F.avg("load").alias("load")).collect()}
    posted = sets.select("sid", "n", "held").mapInArrow(_post(boundary(loads)), "key bigint, sid binary, n int, place int")
    shared = posted.groupBy("key").agg(F.min(F.struct("sid", "n", "place")).alias("least"), F.max("sid").alias("most"), F.count("*").alias("members")).where(F.col("least.sid") < F.col("most"))
    return sets, scratch.table(posted.join(shared.select("key", "least", "members"), "key"), "postings")


def _blocks(active: DataFrame) -> DataFrame:
    """Members of lists dealt to tasks (key, low, high): members outside the list's biggest component meet everyone, those inside it meet only them.

    A list of `BLOCK` shingles at most is one task.  Else both kinds are cut to blocks of
    that size: tasks (low, high) of two blocks of others, and tasks (-1 - high, low) of a
    block of the biggest component and one of others.
    """
    size = active.groupBy("key").agg(*[F.ceil(F.sum(F.when(of, F.length("held") / _BYTES)) / BLOCK).cast("int").alias(name) for of, name in ((F.col("big"), "bigs"), (~F.col("big"), "others"))], F.ceil(F.sum(F.length("held") / _BYTES) / BLOCK).cast("int").alias("blocks"))
    active = active.join(size.select("key", F.greatest("blocks", F.lit(1)).alias("blocks"), F.greatest(F.coalesce("bigs", F.lit(1)), F.lit(1)).alias("bigs"), F.greatest(F.coalesce("others", F.lit(1)), F.lit(1)).alias("others")), "key")
    side = F.pmod(F.hash("sid"), F.when(F.col("big"), F.col("bigs")).otherwise(F.col("others")))
    task = lambda low, high: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))
    with_others = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda x: F.when(F.col("big"), task(-1 - F.col("side"), x)).otherwise(task(F.least("side", x), F.greatest("side", x))))
    with_bigs = F.transform(F.sequence(F.lit(0), F.col("bigs") - 1), lambda x: task(-1 - x, F.col("side")))
    tasks = F.when(F.col("blocks") == 1, F.array(task(F.lit(0), F.lit(0)))).when(F.col("big"), with_others).otherwise(F.concat(with_others, with_bigs))
    dealt = active.withColumn("side", side).withColumn("task", F.explode(tasks))
    # In a task of two kinds of blocks, the sides tell the kinds apart.
    mark = F.when(F.col("task.low") < 0, F.col("big").cast("int")).otherwise(F.col("side"))
    return dealt.select("key", "task.low", "task.high", "sid", "label", "big", "n", "place", mark.alias("side"), "held")


def link(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(sid, component): every set with a link, and the least set it is linked to."""
    sets, postings = _lists(docs, text)
    fits = (4 * F.least("n", "least.n") >= 3 * F.greatest("n", "least.n")) & (7 * F.least(F.col("n") - F.col("place"), F.col("least.n") - F.col("least.place")) >= 3 * (F.col("n") + F.col("least.n")))
    stars = postings.where((F.col("sid") != F.col("least.sid")) & fits).select(F.col("least.sid").alias("a"), F.col("sid").alias("b"))
    links = _verified(stars, sets).where("ok").select("a", "b")
    groups = scratch.table(components(links, "a", "b"), "groups")
    # The pairs of a list's least member have been verified, so it need not meet the others again.
    rest = postings.where(F.col("sid") != F.col("least.sid"))
    named = rest.join(groups, rest.sid == groups.node, "left").select("key", "sid", "n", "place", F.coalesce("component", "sid").alias("label"))
    often = named.groupBy("key", "label").agg(F.count("*").alias("m"))
    mixed = often.groupBy("key").agg(F.max(F.struct("m", "label")).alias("most"), F.count("*").alias("labels"), F.sum("m").alias("members")).where("labels > 1").select("key", F.col("most.label").alias("most"), "members")
    n = scratch.partitions(docs.sparkSession)
    active = named.join(mixed, "key").withColumn("big", F.col("label") == F.col("most")).select("key", "members", "sid", "label", "big", "n", "place")
    few = active.where(F.col("members") <= WALKED).repartition(n, "key").sortWithinPartitions("key").mapInArrow(_partnered, active.schema)
    active = few.union(active.where(F.col("members") > WALKED)).join(sets.select("sid", "held"), "sid")
    more = _blocks(scratch.table(active, "active")).repartition(n, "key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(_compare, "a binary, b binary")
    return components(links.union(scratch.table(more, "links")), "a", "b").select(F.col("node").alias("sid"), "component")


def _told(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, n, sid, component, component_id) of every row; key: hash of the text."""
    scratch.prepare(docs.sparkSession)
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    linked = link(docs, text=text)
    told = rows.mapInArrow(_describe, f"id {kind}, key bigint, n bigint, sid binary")
    told = scratch.table(told.join(linked, "sid", "left").select("id", "key", "n", "sid", F.coalesce("component", "sid").alias("component")), "told")
    least = scratch.table(told.where("component is not null").groupBy("component").agg(F.min("id").alias("least"), F.count("*").alias("m")).where("m > 1").select("component", "least"), "least")
    return told.join(least, "component", "left").select("id", "key", "n", "sid", "component", F.coalesce("least", "id").alias("component_id"))


def groups(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_shingles, sid (equal for equal sets; null for none) and component_id (least id of its group)."""
    return _told(docs, id, text).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "sid", "component_id")


def keep_one(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` (its own columns) with one row of each group, that of the least id; rows without shingles all stay.

    Of a group's rows that share that id, one with the least text hash stays.
    """
    told = _told(docs, id, text).where("sid is not null").select("component", "id", "key")
    kept = scratch.table(told.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("kept")), "kept")
    gone = told.join(kept, "component").where(~(F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("key") == F.col("kept.key")))).select("id", "key").distinct()
    gone, again = scratch.table(gone, "gone"), not told.groupBy("id", "key").count().where("count > 1").isEmpty()
    names = [f"__k{k}" for k in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names).withColumn("__key", F.xxhash64(F.col(of[text]).cast("string")))
    rest = rows.join(gone, rows[of[id]].eqNullSafe(gone.id) & (rows["__key"] == gone.key), "left_anti")
    if again:
        blank = F.coalesce(F.length(F.regexp_replace(of[text], r"[\x20\x09-\x0D]+", "")), F.lit(0)) == 0
        rest = rest.where(blank).unionByName(rest.where(~blank).dropDuplicates([of[id], "__key"]))
    return rest.select(*[F.col(n).alias(c) for c, n in of.items()])

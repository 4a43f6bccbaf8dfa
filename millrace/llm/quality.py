"""Quality classifier by importance resampling over hashed n-grams.

Two generative models over hashed word uni- and bigrams (blank-separated, A-Z lower-cased):
the *target*, of the labelled rows that are good (quality 1, not toxic), and *raw*, of all
documents.  A document's importance is the sum of its distinct n-grams' log ratios target/raw
(distinct: a word that one text repeats thousands of times must not spoil its bucket).
Besides, pairs of marks that end words are n-grams, and so is the share of a text that
says words twice in a row.  Counts are of all documents and all their words; the ratio of a bucket is smoothed towards
1 with `PRIOR` pseudo-counts, and is 1 where its logarithm is under `EFFECT` or the target's
count is within `SIGMAS` standard deviations of what raw predicts, so that chance
differences of thousands of ordinary words do not add up in long texts.

The documents kept are drawn by Gumbel top-k: key = importance + `TEMPERATURE` * Gumbel
noise (seeded by the document's text and id), the k largest keys stay.  k is the number of documents
whose importance reaches a cut, which is fitted on held-out labelled rows (a good
one lost counts as `LOSS` bad ones kept).  The k-th key is found by narrowing histograms, never by a global sort.

Bounds.  At most `LABELLED` labelled rows, those with the least hashes, are used, and sent
to all workers; the two models are arrays of `BUCKETS` numbers.  Neither grows with the data.

Defined cases.  Null, empty or blank texts have importance 0.  Ids are whole numbers (a
text that is none ends the query with Spark's cast error, or counts as null without ANSI
mode).  Labels without an id are
ignored; an id with several labels is good only if all are; a null quality or toxic flag
counts as 1 and 0.  With no good, no bad or no labels at all the cut keeps everything.
Equal keys (repeated rows) stay or go together.  Empty table: empty result.  Further
columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch
from millrace.llm import textkernel as K

#: Buckets of unigrams and of bigrams.
UNIGRAMS, BIGRAMS = 1 << 20, 1 << 18
BUCKETS = UNIGRAMS + BIGRAMS
PRIOR, SIGMAS, OVERDISPERSION, EFFECT = 3.0, 4.0, 1.5, 0.7
TEMPERATURE = 0.05
LOSS = 2
LABELLED = 400_000
SEED = 11
#: Part of the labelled rows that fits the models; the others fit the cut.
FIT_FOLDS, FOLDS = 4, 5
_SCALE = float(1 << 20)
_PARTS, _LANES = 16, 8
_MARKS, _TWICE = np.uint64(1 << 32), np.uint64(1 << 33)


@dataclass
class Labels:
    """Bounded sample of labelled ids, ascending: good or not, and whether it fits the models."""

    ids: np.ndarray
    good: np.ndarray
    fit: np.ndarray

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known good that fits, known) of each id."""
        if not len(self.ids):
            return np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        known = self.ids[at] == ids
        return known & self.good[at] & self.fit[at], known


def labelled(labels: DataFrame, id: str, quality: str, toxic: str, most: int) -> Labels:
    good = (F.coalesce(F.col(quality).cast("int"), F.lit(1)) == 1) & (F.coalesce(F.col(toxic).cast("int"), F.lit(0)) == 0)
    rows = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).cast("bigint").alias("id")).agg(F.min(good).alias("good")).withColumn("h", F.xxhash64("id", F.lit(SEED)))
    rows = rows.orderBy("h").limit(most).select("id", "good", (F.pmod("h", F.lit(FOLDS)) < FIT_FOLDS).alias("fit")).orderBy("id").toPandas()
    return Labels(rows["id"].to_numpy(np.int64), rows["good"].to_numpy(bool), rows["fit"].to_numpy(bool))


def _grams(w: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a block's distinct n-grams of each row, and their rows.

    Uni- and bigrams of words; of words that end in two marks, those marks; and of a row
    how much of it is words said twice in a row, by powers of two.
    """
    two = K.window_hashes(w.hash, 2)
    at = np.flatnonzero(K.windows_within(w.first, 2, len(w.hash)))
    row = w.row()
    last = w.data[w.end - 1].astype(np.uint64)
    before = w.data[np.maximum(w.end - 2, w.start)].astype(np.uint64)
    marked = np.flatnonzero(K.NON_ALNUM[last] & K.NON_ALNUM[before] & (w.end - w.start > 1))
    twice = np.bincount(row[at][w.hash[at] == w.hash[at + 1]], minlength=len(w.first) - 1)
    level = np.log2(1 + 64 * twice / np.maximum(np.diff(w.first), 1)).astype(np.int64)
    said = np.flatnonzero(level)
    shapes = K.mix(np.concatenate((_MARKS + last[marked] * np.uint64(256) + before[marked], _TWICE + level[said].astype(np.uint64))))
    grams = np.concatenate((w.hash & np.uint64(UNIGRAMS - 1), np.uint64(UNIGRAMS) + (np.concatenate((two[at], shapes)) & np.uint64(BIGRAMS - 1)))).astype(np.int64)
    pairs = np.unique(np.concatenate((row, row[at], row[marked], said)) * BUCKETS + grams)
    return pairs % BUCKETS, pairs // BUCKETS


def _count(share):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, totals = share.value, np.zeros((2, BUCKETS), np.int64)
        seen = False
        for batch in batches:
            good, _ = labels.of(batch.column(0).fill_null(-1).to_numpy())
            good &= batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            data, offsets = K.rows_of(batch.column(1))
            for i, j in K.blocks(offsets):
                grams, row = _grams(K.words_of(data, offsets[i : j + 1], K.BLANK, lower=True))
                totals[1] += np.bincount(grams, minlength=BUCKETS)
                mine = grams[good[i:j][row]]
                if len(mine):
                    totals[0] += np.bincount(mine, minlength=BUCKETS)
                seen = True
        if seen:
            parts = totals.reshape(2, _PARTS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()), pa.array([parts[:, k].tobytes() for k in range(_PARTS)], pa.binary())], ["part", "counts"])

    return count


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            totals[part] = totals.get(part, 0) + np.frombuffer(counts, np.int64)
    if totals:
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([x.tobytes() for x in totals.values()], pa.binary())], ["part", "counts"])


def usual_share(target: np.ndarray, raw: np.ndarray) -> float:
    """The target's share of a bucket's count, as the median (by raw counts): words that only bad texts have don't shift it."""
    if not target.any():
        return 0.0
    own = np.divide(target, raw, out=np.zeros(len(raw)), where=raw > 0)
    order = np.argsort(own)
    upto = np.cumsum(raw[order])
    return float(own[order[np.searchsorted(upto, upto[-1] / 2)]]) or target.sum() / raw.sum()


def ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket, in units of 2**-20."""
    share = usual_share(target, raw)
    expected = raw * share
    ratio = np.log((target + PRIOR) / (expected + PRIOR))
    chance = np.abs(target - expected) <= SIGMAS * np.sqrt(OVERDISPERSION * (expected + 1))
    return np.where(chance | (np.abs(ratio) < EFFECT) | (share == 0), 0, np.rint(ratio * _SCALE)).astype(np.int64)


def _noise(h: np.ndarray) -> np.ndarray:
    """Gumbel noise of 64-bit hashes."""
    u = ((K.mix(h.view(np.uint64) ^ np.uint64(SEED)) >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)
    return -np.log(-np.log(u))


def _score(share, temperature: float):
    """Adds importance and key, from the last two columns: seed and text."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = share.value
        for batch in batches:
            n = batch.num_columns
            data, offsets = K.rows_of(batch.column(n - 1))
            sums = []
            for i, j in K.blocks(offsets):
                grams, row = _grams(K.words_of(data, offsets[i : j + 1], K.BLANK, lower=True))
                exact = np.zeros(j - i, np.int64)
                value = table[grams]
                at = np.flatnonzero(value)
                np.add.at(exact, row[at], value[at])
                sums.append(exact)
            importance = (np.concatenate(sums) if sums else np.zeros(0, np.int64)) / _SCALE
            key = importance + temperature * _noise(batch.column(n - 2).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[: n - 2], pa.array(importance, pa.float64()), pa.array(key, pa.float64())], [*batch.schema.names[: n - 2], "importance", "key"])

    return score


def fit_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The importance that parts two samples at the least cost (a good one lost: `LOSS`, a bad one kept: 1); the lowest of equals."""
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.concatenate((good, bad)))
    cuts = np.concatenate(([values[0]], (values[1:] + values[:-1]) / 2))
    good, bad = np.sort(good), np.sort(bad)
    right = np.searchsorted(bad, cuts) - LOSS * np.searchsorted(good, cuts)
    return float(cuts[int(np.argmax(right))])


def kth_largest(table: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column; None for k = 0.  Histograms narrow down to one value or few rows."""
    if k <= 0:
        return None
    rest, left = table.select(F.col(column).alias("x")), k
    while True:
        s = rest.agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).first()
        if s.n <= 50_000 or s.a == s.b:
            return s.a if s.a == s.b else rest.orderBy(F.desc("x")).limit(left).agg(F.min("x")).first()[0]
        step = (s.b - s.a) / 4096
        cell = F.least(F.floor((F.col("x") - s.a) / step), F.lit(4095)).cast("int")
        above = 0
        for r in sorted(rest.groupBy(cell.alias("c")).count().collect(), key=lambda r: -r.c):
            if above + r["count"] >= left:
                rest, left = rest.where(cell == r.c), left - above
                break
            above += r["count"]


def classify(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", quality: str = "quality", toxic: str = "toxic", most_labels: int = LABELLED, temperature: float = TEMPERATURE, k: int | None = None) -> DataFrame:
    """`docs` with importance and accepted (of the k drawn; k: fitted unless given)."""
    spark = docs.sparkSession
    scratch.prepare(spark)
    names = [f"__k{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    number, body = F.col(of[id]).cast("bigint"), F.col(of[text]).cast("string")
    known = labelled(labels, id, quality, toxic, most_labels)
    share = spark.sparkContext.broadcast(known)
    # A task sends two whole arrays, so there are only as many tasks as shuffle partitions (or cores), and they are added up in two steps
    tasks = max(scratch.partitions(spark), spark.sparkContext.defaultParallelism)
    arrays = rows.select(number.alias("id"), body.alias("text")).coalesce(tasks).mapInArrow(_count(share), "part int, counts binary")
    some = arrays.withColumn("lane", F.spark_partition_id() % _LANES).repartition(_PARTS * _LANES, "part", "lane").select("part", "counts").mapInArrow(_add, "part int, counts binary")
    counted = some.repartition(_PARTS, "part").mapInArrow(_add, "part int, counts binary")
    totals = np.zeros((2, _PARTS, BUCKETS // _PARTS), np.int64)
    for r in counted.collect():
        totals[:, r.part] += np.frombuffer(r.counts, np.int64).reshape(2, -1)
    totals = totals.reshape(2, -1)
    model = spark.sparkContext.broadcast(ratios(totals[0], totals[1]))
    seed = F.xxhash64(body, number)
    scored = scratch.table(rows.select(number.alias("id"), seed.alias("seed"), body.alias("text")).mapInArrow(_score(model, temperature), "id bigint, importance double, key double"), "scored")
    if k is None:
        held = scored.where("id is not null").mapInArrow(_held_out(share), "good boolean, importance double").toPandas()
        cut = fit_cut(held["importance"][held["good"]].to_numpy(), held["importance"][~held["good"].astype(bool)].to_numpy())
        k = scored.where(F.col("importance") >= cut).count()
    least = kth_largest(scored, "key", k)
    scratch.drop(scored)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    got = rows.select(*names, seed.alias("__seed"), body.alias("__text")).mapInArrow(_score(model, temperature), f"{schema}, importance double, key double")
    accepted = F.lit(False) if least is None else F.col("key") >= least
    new = {"importance": F.col("importance"), "accepted": accepted}
    return got.select(*[F.col(n).alias(c) for c, n in of.items() if c not in new], *[x.alias(c) for c, x in new.items()])


def _held_out(share):
    """(id, importance, key) to the labelled rows that did not fit the models: LABELLED at most, but for repeated ids."""
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = share.value
        for batch in batches:
            if not len(labels.ids):
                continue
            ids = batch.column(0).to_numpy()
            at = np.minimum(np.searchsorted(labels.ids, ids), len(labels.ids) - 1)
            mine = np.flatnonzero((labels.ids[at] == ids) & ~labels.fit[at])
            yield pa.RecordBatch.from_arrays([pa.array(labels.good[at[mine]], pa.bool_()), batch.column(1).take(pa.array(mine))], ["good", "importance"])

    return held

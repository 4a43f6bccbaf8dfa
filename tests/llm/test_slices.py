"""The packed exchange: owners of hashes, bytes by number of slices, hot hashes, many partitions."""

import numpy as np
import pytest

from millrace.llm import slices, substrings, suffixes


@pytest.mark.parametrize("n_rows", [1, 7, 70_000])
def test_owners_round_trip(n_rows):
    rng = np.random.default_rng(n_rows)
    for n in (1, 5, 400, 300_000):
        row = np.sort(rng.integers(0, n_rows, n))
        raw = slices.pack_owners(row, n_rows)
        assert (slices.owners(raw) == row).all() and len(raw) <= 1 + min(4 * n_rows, n * (2 if n_rows <= 65536 else 4))
    assert len(slices.owners(slices.pack_owners(np.empty(0, np.int64), n_rows))) == 0


def test_bytes_do_not_grow_with_the_slices():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 150_000).astype(np.uint64) * np.uint64(2)
    row = np.sort(rng.integers(0, 300, 150_000))
    sent = []
    for n in (50, 500, 5000):
        batch = slices.pack(1, np.arange(n, dtype=np.int32), row, 300, hashes, 8, (b"", b""))
        sent.append(sum(len(x) for k in (3, 4) for x in batch.column(k).to_pylist()))
        got = slices.Gathered(iter([batch]), 8)
        assert sorted(zip(got.hashes.tolist(), np.concatenate([slices.owners(p[2]) for p in got.parts]).tolist(), strict=True)) == sorted(zip(hashes.tolist(), row.tolist(), strict=True))
    assert max(sent) < 1.25 * min(sent)


def test_slice_numbers_beyond_two_bytes():
    assert suffixes._slice_kind(65536) is np.uint16 and suffixes._slice_kind(65537) is np.uint32


def test_hot_window_over_many_partitions(spark):
    """One passage in every document, over more partitions than documents' slices are filled; and a text longer than a block."""
    passage = " ".join(f"p{k}" for k in range(60))
    long = " ".join(f"z{k % 9973}x{k}" for k in range(120_000))
    rows = [(i, f"own{i} " + passage + f" tail{i}") for i in range(300)] + [(300, long + " " + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        got = {r.doc_id: sum(s.n_words for s in r.removed) for r in substrings.dedup(docs).collect()}
        cut = {r.doc_id: (r.n_bytes, sum(s.end - s.begin for s in r.removed)) for r in suffixes.dedup(docs.where("doc_id = 300").union(docs.where("doc_id = 300"))).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert len(long) > 1 << 20 and got == {i: 60 if i else 0 for i in range(301)}
    assert cut == {300: (len(rows[300][1]), len(rows[300][1]))}

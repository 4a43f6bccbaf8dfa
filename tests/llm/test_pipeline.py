"""The pipeline's stages, each on its own input, against brute force or what it promises."""

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import lines, mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        where = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, SF).write.parquet(where)
        docs = spark.read.parquet(where)
        out.append(docs)
    return out


def test_columns_and_subsets(steps):
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in steps]
    assert all(b <= a for a, b in zip(ids[:-1], ids[1:], strict=True))
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_line_stage(steps):
    seen, want = set(), {}
    for r in sorted(steps[1].collect(), key=lambda r: r.doc_id):
        raw = r.text.encode()
        begin, end, one, two = lines.chunks(np.frombuffer(raw, np.uint8))
        keep = []
        for a, b, x, y in zip(begin.tolist(), end.tolist(), one.tolist(), two.tolist(), strict=True):
            if not ((x or y) and raw[a:b] in seen):
                keep.append(raw[a:b])
            if x or y:
                seen.add(raw[a:b])
        if b"\n".join(keep) or not raw:
            want[r.doc_id] = b"\n".join(keep).decode()
    got = {r.doc_id: r.text for r in steps[2].collect()}
    assert got == want and all(r.n_chars == len(r.text) for r in steps[2].collect() if r.doc_id in want)


def shingles(t):
    w = (t or "").lower().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def test_near_stage_leaves_one_of_each_group(steps):
    before = {r.doc_id: shingles(r.text) for r in steps[2].collect()}
    after = {r.doc_id for r in steps[3].collect()}
    near = lambda a, b: bool(a and b) and 4 * len(a & b) >= 3 * len(a | b)
    assert not any(near(before[a], before[b]) for a in after for b in after if a < b)
    for k in before.keys() - after:
        assert any(near(before[k], before[x]) for x in before if x != k)


def test_decontamination_stage(spark, steps):
    from millrace.llm import decontaminate

    assert decontaminate.report(steps[4], spark.read.parquet(f"{SF}/benchmark.parquet")).where("n_hit > 0").count() == 0
    assert steps[4].count() < steps[3].count()


def test_mix_stage(steps):
    want = {(r.doc_id, r.taken) for r in mixing.mix(steps[4]).collect() if r.taken}
    assert {(r.doc_id, r.taken) for r in steps[5].collect()} == want


def test_stages_of_odd_tables(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows, names that operators use themselves, no n_chars; and no rows at all."""
    long = "\n".join(" ".join(f"w{k}x{j % 131}" for j in range(60)) for k in range(4000))
    same = "one two three four five six seven\neight nine ten eleven twelve thirteen"
    rows = [(1, same, "a"), (2, same, "a"), (2, same, "a"), (None, same + " more", None), (3, None, "a"), (4, "", None), (5, " \n ", "b"), (6, long, "b"), (None, None, None), (7, "x y", "b")]
    names = ["accepted", "importance", "removed_chunks", "key", "sid", "component", "items", "spans", "n_words", "__text", "__k0"]
    docs = spark.createDataFrame([(*r, *[f"{n}{k}" for n in names]) for k, r in enumerate(rows)], "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "x y")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert len(long) > 1 << 20
    want = {"quality": range(10), "line_dedup": [0, 3, *range(4, 10)], "near_dedup": [0, 4, 5, 6, 7, 8, 9], "decontaminate": range(9), "mix": None}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, str(tmp_path)).collect()
        own = sorted(int(r["accepted"].removeprefix("accepted")) for r in kept)
        assert all(r[c] == f"{c}{r['accepted'].removeprefix('accepted')}" for r in kept for c in names)  # no operator wrote over them
        if name == "mix":
            assert own and all(r.taken > 0 and r.size > 0 for r in kept) and not {4, 5, 6, 8} & set(own)
        elif name == "near_dedup":
            assert len(own) == 7 and {4, 5, 6, 7, 8, 9} < set(own)
            assert [r.doc_id for r in kept if r.text == same] == [1]
        else:
            assert own == list(want[name]) and all(r.text == rows[int(r["accepted"].removeprefix("accepted"))][1] for r in kept)
            assert list(kept[0].asDict()) == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_a_run_leaves_other_tables_alone(spark):
    from millrace.llm import jaccard

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lazy = jaccard.groups(docs)
    n = docs.count()
    corpus_pipeline.line_dedup(spark, docs, SF).count()
    corpus_pipeline.near_dedup(spark, docs, SF).count()
    assert lazy.count() == n


def test_run_gives_the_stages_rows(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select(steps[5].columns).collect())) == sorted(map(tuple, steps[5].collect()))

"""Dedup operators against brute force, and their defined cases."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import embeddings, jaccard, lines, substrings, suffixes

DOCS = "doc_id long, text string, n_words string, hit string, key string, `__key` string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", None, "b", "c") for r in rows], DOCS)


def words(t):
    out, w = [], ""
    for c in t or "":
        if c in " \t\n\x0b\x0c\r":
            out, w = (out + [w] if w else out), ""
        else:
            w += c
    return out + [w] if w else out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    vocab = [rng.choice("abcdefghijk") * rng.randrange(1, 4) + str(rng.randrange(40)) + rng.choice(["", "é", "日本"]) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage, line = sentence(80), sentence(12)
    texts = [sentence(rng.randrange(1, 200)) for _ in range(60)]
    for _ in range(60):
        t = rng.choice(texts).split(" ")
        kind = rng.randrange(6)
        if kind == 0:
            texts.append(" ".join(t))
        elif kind == 1:
            for _ in range(max(1, len(t) // 40)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            texts.append(" ".join(t).upper() if rng.random() < 0.3 else " ".join(t))
        elif kind == 2:
            texts.append(" ".join(t[:20]) + " " + passage + "\n" + sentence(30))
        elif kind == 3:
            texts.append("\n".join([line, sentence(4), line, sentence(5), *[sentence(6) for _ in range(8)]]))
        elif kind == 4:
            texts.append(" ".join(t[: rng.randrange(1, 9)]))
        else:
            texts.append(passage + " " + passage)
    texts += ["", None, "  \n ", "x", "a a a a a a a a a a", "z" * 3000, "z" * 3001, "one two three", "ONE two three", "\n\n\n\n"]
    return list(enumerate(texts))


def test_jaccard_groups(spark, corpus):
    sets = {}
    for i, t in corpus:
        w = "".join(c.lower() if c < "\x7f" else c for c in t or "")
        w = words(w)
        n = min(len(w), 5)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in range(a):
            o = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.groups(frame(spark, corpus)).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in sets}
    kept = jaccard.keep_one(frame(spark, corpus))
    assert kept.columns == frame(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in sets if root(i) == i]


def test_jaccard_small_sets_meet_by_subsets(spark):
    rng = random.Random(2)
    rows = []
    for i in range(80):
        w = rng.sample(range(14), rng.randrange(1, 12))
        rows.append((i, " ".join(f"w{x}" for x in sorted(w))))
    test_jaccard_groups(spark, rows)
    assert jaccard.boundary({n: 1e9 for n in range(1, 30)}) == jaccard.LIGHT_MOST and jaccard.boundary({4: 2.0}) < 4


def test_a_list_gives_a_forest_of_its_links():
    held = jaccard.slices.narrow(np.arange(1, 11, dtype=np.uint64) << np.uint64(16), 6)
    rows = [(bytes([i]), bytes([i]), i == 0, 10, 0, i % 2, held) for i in range(9)]
    assert len(jaccard._list_links(list(rows), False, False)) == 8
    assert len(jaccard._list_links(list(rows), True, False)) == 8  # two sides: every pair of sides links
    assert jaccard._list_links(rows[::2], True, False) == []
    later = [(*r[:4], 1, *r[5:]) for r in rows]
    assert jaccard._list_links(later, False, False) == []  # they met before, in the list of their first shingle
    assert len(jaccard._list_links(later, False, True)) == 8


@pytest.mark.parametrize("block", [jaccard.BLOCK, 2000])
def test_large_group_of_near_copies(spark, monkeypatch, block):
    """Copies that the least of a list does not link to meet pair by pair, and a list gives fewer links than it has members."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(5)
    rows = []
    for g in range(3):
        base = [f"g{g}w{k}" for k in range(60)]
        for i in range((300, 40, 8)[g]):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(300)}"
            rows.append((len(rows), " ".join(w)))
    test_jaccard_groups(spark, rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (7, "q"), (None, None)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard.groups(frame(spark, rows)).collect())
    assert got == sorted([(-1, 2, 7), (-1, 2, 7), (7, 2, 7), (7, 2, 7), (7, 1, 7), (-1, 0, None)], key=lambda x: x[:2])
    assert jaccard.keep_one(frame(spark, rows)).where("text = 'a b c d e f'").count() == 1


def test_substring_dedup(spark, corpus):
    w = {i: words(t) for i, t in corpus}
    first = {}
    for i in sorted(w):
        for k in range(len(w[i]) - 49):
            first.setdefault(tuple(w[i][k : k + 50]), i)
    want = {}
    for i in w:
        gone = set()
        for k in range(len(w[i]) - 49):
            if first[tuple(w[i][k : k + 50])] < i:
                gone |= set(range(k, k + 50))
        want[i] = (len(w[i]), len(gone), " ".join(x for k, x in enumerate(w[i]) if k not in gone))
    got = {r.doc_id: (r.n_words, sum(s.n_words for s in r.removed), r.kept) for r in substrings.dedup(frame(spark, corpus)).collect()}
    assert got == want


def test_substring_null_ids_come_last(spark):
    t = " ".join(f"w{k}" for k in range(60))
    got = [(r.doc_id, r.n_words, len(r.removed)) for r in substrings.dedup(frame(spark, [(None, t), (None, t), (3, t), (3, t), (4, t)])).collect()]
    assert sorted(got, key=str) == sorted([(None, 60, 1), (None, 60, 1), (3, 60, 0), (3, 60, 0), (4, 60, 1)], key=str)


def brute_suffix(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for k in range(len(b) - 399):
            seen[b[k : k + 400]] = seen.get(b[k : k + 400], 0) + 1
    out = []
    for b in raw:
        edge = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                edge[k] += 1
                edge[k + 400] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup(spark, corpus, seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé \n") for _ in range(2600))
    texts = [t for _, t in corpus] if seed == 1 else [base[a : a + n] for a, n in [(0, 399), (0, 400), (100, 400), (100, 401), (5, 1500), (700, 900), (1000, 463), (1000, 464), (900, 463), (37, 430)]]
    texts += [base[:300] + base[900:1400] + base[10:450], "ab" * 600, "ba" * 450, "a" * 900]
    want = dict(enumerate(brute_suffix(texts)))
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.begin for s in r.removed), len(r.removed), bytes(r.kept)) for r in suffixes.dedup(frame(spark, list(enumerate(texts)))).collect()}
    assert got == want


def periodic_texts(seed):
    rng = random.Random(seed)
    some = lambda: "".join(rng.choice("abcdefgh \n") for _ in range(rng.randrange(1, 300)))
    pool = ["".join(rng.choice("abcdefgh ,") for _ in range(rng.randrange(1, 50))) for _ in range(3)]
    heads = [some() for _ in range(2)]
    for _ in range(8):
        text = rng.choice([*heads, some()])
        for _ in range(rng.randrange(1, 3)):
            piece = rng.choice(pool)
            text += piece * rng.randrange(1, 1 + 700 // len(piece))
        yield text + rng.choice([*heads, some()])


def test_suffix_dedup_of_periodic_texts(spark):
    """A piece said again and again holds the same inner phrases at several places of equal outer ones."""
    texts = [t for seed in (47, 78, 81, 86, 93, 98, 124) for t in periodic_texts(seed)]
    want = dict(enumerate(brute_suffix(texts)))
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.begin for s in r.removed), len(r.removed), bytes(r.kept)) for r in suffixes.dedup(frame(spark, list(enumerate(texts)))).collect()}
    assert sorted(got) == sorted(want)
    assert [k for k in want if got[k] != want[k]] == []


def test_suffix_repeated_rows_are_partners(spark, monkeypatch):
    """Of repeated rows (same id, or none) only one is sent to be compared, and it may come after the others."""
    from pyspark.sql import functions as F

    rng = random.Random(17)
    text = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    rows = []
    for k in range(6):
        passage = text(rng.randrange(401, 900))
        a = text(rng.randrange(1, 700)) + passage + text(rng.randrange(1, 700))
        rows += [(2 * k if k % 2 else None, a)] * 2 + [(2 * k + 1, text(rng.randrange(1, 700)) + passage + text(rng.randrange(1, 700)))]
    exchange = suffixes.slices.exchange

    def turned(*args):
        got = exchange(*args)
        return got.coalesce(1).sortWithinPartitions(F.length("open")) if "open" in got.columns else got

    monkeypatch.setattr(suffixes.slices, "exchange", turned)
    want = [(i, *w) for (i, _), w in zip(rows, brute_suffix([t for _, t in rows]), strict=True)]
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.removed), len(r.removed), bytes(r.kept)) for r in suffixes.dedup(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_line_dedup(spark, corpus):
    got = {r.doc_id: (r.text, r.removed_chunks) for r in lines.dedup(frame(spark, corpus)).collect()}
    seen = set()
    for i, t in corpus:
        if t is None:
            assert got[i] == (None, 0)
            continue
        begin, end, one, two = lines.chunks(np.frombuffer(t.encode(), np.uint8))
        keep, gone = [], 0
        for a, b, x, y in zip(begin.tolist(), end.tolist(), one.tolist(), two.tolist(), strict=True):
            c = t.encode()[a:b]
            if (x or y) and c in seen:
                gone += 1
            else:
                keep.append(c)
            if x or y:
                seen.add(c)
        assert got[i] == (b"\n".join(keep).decode(), gone)


def without_runs(rows):
    seen, out = {}, []
    for k, (i, t) in enumerate(rows):
        for n in range((t or "").count("\n")):
            w = tuple(t.split("\n")[n : n + 2])
            if any(w):
                seen[w] = min(seen.get(w, (float("inf"), "", 0)), (float("inf") if i is None else i, t, n))
    for i, t in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        ls = t.split("\n")
        drop = set()
        for n in range(len(ls) - 1):
            if any(ls[n : n + 2]) and seen[tuple(ls[n : n + 2])] != (float("inf") if i is None else i, t, n):
                drop |= {n, n + 1}
        for n in range(len(ls) if drop else 0):
            if not ls[n]:
                a, b = n, n
                while a >= 0 and not ls[a] and a not in drop:
                    a -= 1
                while b < len(ls) and not ls[b] and b not in drop:
                    b += 1
                if (a < 0 or a in drop) and (b == len(ls) or b in drop):
                    drop.add(n)
        kept = "\n".join(x for n, x in enumerate(ls) if n not in drop)
        out.append((i, kept, sum(n in drop and n - 1 not in drop for n in range(len(ls)))))
    return out


def test_line_runs_go_whatever_is_around_them(spark, corpus):
    rng = random.Random(12)
    fresh = lambda n: [" ".join(f"n{rng.randrange(10**9)}" for _ in range(12)) for _ in range(n)]
    rows, planted = list(corpus), {}
    for k in range(30):
        run = fresh(rng.randrange(2, 7))
        rows.append((1000 + k, "\n".join(fresh(rng.randrange(4)) + run + fresh(rng.randrange(1, 4)))))
        around = fresh(rng.randrange(1, 4)), fresh(rng.randrange(4))
        rows.append((2000 + k, "\n".join(around[0] + run + around[1])))
        planted[2000 + k] = "\n".join(around[0] + around[1])
    one = fresh(1)[0]
    rows += [(3000 + k, "\n".join([fresh(1)[0], one, fresh(1)[0]])) for k in range(3)]
    rows += [(None, "p\nq\nr"), (None, "p\nq\nr"), (9, "p\nq\nr\ns"), (9, "p\nq\nr\ns"), (8, "\n\nq\nr\n\n\nt\nt\nt"), (7, "u\n\n\n\nv"), (10, "u\n\n\n\nv"), (11, "\n\n\n\nu\n\n\n\nv")]
    got = [(r.doc_id, r.text, r.removed_chunks) for r in lines.dedup(frame(spark, rows), runs=True).collect()]
    assert sorted(got, key=str) == sorted(without_runs(rows), key=str)
    kept = {i: t for i, t, _ in got}
    assert {i: kept[i] for i in planted} == planted and all(one in kept[3000 + k] for k in range(3)) and kept[10] == ""


def test_line_query_drops_runs(spark, tmp_path):
    from millrace.llm import queries

    texts = [f"{a}1\n{a}2\nthe passage has\ntwo lines of its own\n{a}3" for a in "abcdefgh"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.kept_chars for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: len(texts[0]) if i == 0 else len("a1\na2\na3") for i in range(8)}


def test_line_runs_meet_by_chunks_first():
    """Before, windows met without chunks: a copy sent all its windows."""
    import pyarrow as pa

    rng = random.Random(6)
    body = [f"line {rng.random()}" for _ in range(60)]
    texts = ["\n".join(body), "\n".join(["new", *body]), "one line"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array(texts)], ["id", "key", "text"])
    (met,) = list(lines._windowed(iter([batch])))
    rows = met.to_pylist()
    for k, t in enumerate(texts[:2]):
        begin = lines.chunks(np.frombuffer(t.encode(), np.uint8))[0].tolist()
        assert [r["place"] for r in rows if r["id"] == k + 1] == [t[:b].count("\n") for b in begin]
    whole, shifted = ({(r["h1"], r["h2"]) for r in rows if r["id"] == k} for k in (1, 2))
    assert len(whole & shifted) >= len(whole) - 3
    (windows,) = list(lines._unpacked(iter([met.select(["id", "key", "place", "body"])])))
    assert [(r["id"], r["place"]) for r in windows.to_pylist()] == [(1, k) for k in range(59)] + [(2, k) for k in range(60)]


def test_line_chunks_resist_shifts():
    rng = random.Random(4)
    body = [f"line {rng.random()}" for _ in range(60)]
    cut = lambda ls: {hashlib.md5(t[a:b]).digest() for t in ["\n".join(ls).encode()] for a, b in zip(*[x.tolist() for x in lines.chunks(np.frombuffer(t, np.uint8))[:2]], strict=True)}
    whole, shifted = cut(body), cut(["new"] + body)
    assert len(whole & shifted) >= len(whole) - 3


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((12, 16))
    rows = []
    for i in range(150):
        v = centre[i % 12] + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.16, 0.5])
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(0, 2))))
    rows += [(200, rows[0][1], rows[0][2]), (201, rows[0][1], None), (202, None, 0), (203, [0.0] * 16, 0), (204, [float("nan")] * 16, 0), (205, [], 0), (206, rows[0][1][:8], rows[0][2]), (207, [None] * 16, 0), (208, [float("inf")] * 16, 0), (0, rows[0][1], rows[0][2])]
    fine = lambda v: v and None not in v and all(np.isfinite(v)) and any(v)
    n = len(rows)
    links = [set() for _ in rows]
    for a in range(n):
        for b in range(n):
            x, y = rows[a], rows[b]
            if a != b and x[2] is not None and x[2] == y[2] and fine(x[1]) and fine(y[1]) and len(x[1]) == len(y[1]):
                u, v = np.array(x[1], np.float64), np.array(y[1], np.float64)
                if u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98:
                    links[a].add(b)
    comp = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in links[a]:
                if comp[b] < comp[a]:
                    comp[a], changed = comp[b], True
    least = {}
    for a in range(n):
        least[comp[a]] = min(least.get(comp[a], rows[a][0]), rows[a][0])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in embeddings.dedup(df).collect())
    assert got == sorted((rows[a][0], len(links[a]), least[comp[a]], rows[a][0] == least[comp[a]]) for a in range(n))
    assert embeddings.dedup(df.limit(0)).count() == 0


def test_big_buckets_are_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(i, (np.ones(8) + rng.standard_normal(8) * 0.01).tolist(), 1) for i in range(40)]
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    got = embeddings.dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(39, 0)}


@pytest.mark.parametrize("run", [jaccard.groups, jaccard.keep_one, substrings.dedup, suffixes.dedup, lines.dedup])
def test_empty_tables_and_only_nulls(spark, run):
    assert run(frame(spark, [])).count() == 0
    assert run(frame(spark, [(None, None), (1, None), (1, "")])).count() == 3


@pytest.mark.parametrize("local", [0, 10**6])
def test_components(spark, monkeypatch, local):
    from millrace.llm import components

    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)] + [(2000, k) for k in range(2001, 2030)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}

"""Decontamination, mixing, chat formatting, quality and language-model scoring against brute force."""

import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, decontaminate, mixing, ngram_lm, quality

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def alnum(t):
    return ALNUM.findall((t or "").translate(LOWER))


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(1)
    vocab = ["Ab", "ab", "é", "x1", "日本", "zz", "q-r", "No", "no9"] + [f"w{k}" for k in range(30)]
    say = lambda n: rng.choice([" ", "  ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(k, say(rng.choice([1, 2, 4, 9, 10, 11, 25]))) for k in range(25)] + [(25, None), (26, ""), (27, "!!"), (None, say(12)), (3, say(14))]
    docs = []
    for k in range(80):
        t = say(rng.randrange(0, 60))
        if rng.random() < 0.5:
            t += " " + (rng.choice(items)[1] or "").upper() + "; " + say(5)
        docs.append((k, t))
    return docs + [(80, None), (81, ""), (None, items[6][1]), (5, items[6][1]), (5, items[6][1])], items


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 300])
def test_decontamination(spark, leaks, block_chars):
    docs, items = leaks
    grams = set()
    for k, t in items:
        w = alnum(t)
        n = min(10, len(w))
        grams |= {(tuple(w[i : i + n]), "" if k is None else str(k)) for i in range(len(w) - n + 1) if n}
    want = []
    for k, t in docs:
        w, hit, found = alnum(t), set(), set()
        for g, item in grams:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(item)
        want.append((k, len(w), len(hit), sorted(found)))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("n_words", F.lit("x"))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in decontaminate.report(d, b, block_chars=block_chars).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    clean = decontaminate.remove(d, b, block_chars=block_chars)
    assert clean.columns == d.columns and sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(x[0]) for x in want if not x[2])
    cut = decontaminate.remove(d, b, whole=False, block_chars=block_chars)
    assert sorted((str(r.doc_id), len(alnum(r.text))) for r in cut.collect()) == sorted((str(x[0]), x[1] - x[2]) for x in want)


def test_decontamination_of_nothing(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(d, b).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.report(one, b).first().n_hit == 0 and decontaminate.remove(one, b).count() == 1


def test_targets_fill_up(spark):
    rng = random.Random(6)
    for sizes in ([5, 100, 1], [rng.randrange(1000) for _ in range(9)], [0, 0], [7]):
        names = [f"s{k}" for k in range(len(sizes) - 1)] + [None]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")).collect()}
        target, free = dict.fromkeys(names, 0.0), {n: k % 3 + 1 for k, n in enumerate(names)}
        cap, left = dict(zip(names, [3 * s for s in sizes], strict=True)), float(sum(sizes))
        while free:
            level = left / sum(free.values())
            full = [n for n, w in free.items() if level * w > cap[n]]
            if not full:
                target |= {n: level * w for n, w in free.items()}
                break
            for n in full:
                target[n] = cap[n]
                left -= cap[n]
                del free[n]
        assert got == pytest.approx(target)


def test_mix(spark):
    rng = random.Random(2)
    rows = [(k, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 30))), rng.choice(["a", "a", "b", "c", None])) for k in range(300)]
    rows += [(None, "x y", "a"), (None, "x y", "a"), (7, None, "b"), (7, None, "b")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("old"))
    got = mixing.mix(d).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(d).collect()), key=str)
    assert len(got) == len(rows)
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert sum(r.size for r in own) == own[0].source_size and all(0 <= r.taken <= 3 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 30
        epochs = {r.taken // r.size for r in own if r.size}
        assert max(epochs) - min(epochs) <= 1
    assert mixing.mix(d.limit(0)).count() == 0
    numbers = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, mixing.mix(d, keep=["doc_id"]).select(numbers).collect()), key=str) == sorted(map(tuple, mixing.mix(d).select(numbers).collect()), key=str)


@pytest.mark.parametrize("text", ["", "<|end|>\n", "\\", "\\<|", "a<", "<", "|>", "<|next|><|start|>", "\\### Assistant: </turn> ok", "x\n\n<|text|>\\\\", "日<|本"])
def test_chat_round_trip(spark, text):
    turns = [(1, 2, "assistant", text), (1, 0, "user", text), (1, 1, "user<|", "u"), (1, 3, "assistant", "<|x"), (1, 4, "assistant", None), (2, 0, None, text)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    got = chat.format_conversations(rows).select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("m"))
    got = {r.conv_id: r for r in got.collect()}
    assert [tuple(t) for t in got[1].t] == [("user", text), ("user<|", "u"), ("assistant", text), ("assistant", "<|x"), ("assistant", "")]
    assert got[1].m == text + "<|x" and got[1].formatted.count("<|next|>") == 2
    assert [tuple(t) for t in got[2].t] == [("", text)] and got[2].m == ""


def test_chat_ties_and_null_turns(spark):
    """Rows of one turn are ordered by role, then text, as they are: an escape would put '<|' before '<a'."""
    rows = spark.createDataFrame([(1, 0, "user", "<|"), (1, 0, "user", "<a"), (1, None, "user", "first"), (1, 0, "assistant", "x"), (1, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(rows).select(chat.parse(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("m")).first()
    assert [tuple(t) for t in got.t] == [("user", "first"), ("assistant", "x"), ("assistant", "x"), ("user", "<a"), ("user", "<|")] and got.m == "xx"


def test_decontamination_of_long_texts(spark):
    """A text longer than a block of the scan, with the item at its end."""
    item = " ".join(f"q{k}" for k in range(12))
    long = " ".join(f"w{k % 977}" for k in range(320_000))
    docs = spark.createDataFrame([(1, long + " " + item), (2, long)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.report(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert len(long) > 1 << 20 and got == {1: (320_012, 12), 2: (320_000, 0)}


def test_no_conversations(spark):
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def labelled(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for k in range(1500):
        bad = k % 6 == 0
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 120))]
        if bad:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["nasty", "vile"])
        docs.append((k, " ".join(w)))
        labels.append((k, int(not bad), 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r.accepted for r in quality.classify(docs.withColumn("accepted", F.lit("old")), labels.where("doc_id % 2 = 0 or doc_id % 3 = 0")).collect()}
    unseen = [k for k in got if k % 2 and k % 3]
    assert sum(got[k] for k in unseen) > 0.97 * len(unseen)
    bad = [k for k in got if k % 6 == 0]
    assert sum(got[k] for k in bad) < 0.05 * len(bad)
    assert quality.classify(docs, labels, k=10).where("accepted").count() == 10


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, "a b"), (2, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, none).where("accepted").count() == 4
    odd = spark.createDataFrame([(None, 0, 1), (2, None, None), (2, 0, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, odd).count() == 4
    assert quality.classify(docs.limit(0), odd).count() == 0


def test_cut_and_selection(spark):
    good, bad = np.array([0.0, 0, 0, -1]), np.array([-5.0, -3, 0])
    assert -3 < quality.fit_cut(good, bad) <= -1
    assert quality.fit_cut(good, good[:0]) == -np.inf
    t = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    assert quality.kth_largest(t, "x", 25) == sorted((float(k % 97) for k in range(1000)), reverse=True)[24]
    assert quality.kth_largest(t, "x", 0) is None


TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    pairs = {f"t{k}": f"t{rng.randrange(60)}" for k in range(60)}
    rows = []
    for k in range(300):
        w = ["t0"]
        for _ in range(rng.randrange(0, 60)):
            w.append(pairs[w[-1]] if rng.random() < 0.6 else f"t{rng.randrange(60)}")
        rows.append((k, rng.choice([" ", "\n"]).join(w).upper() if k % 7 == 0 else " ".join(w)))
    return rows + [(300, None), (301, ""), (None, "t1 t2"), (5, "t1 new"), (5, "t1 new")]


def held(k):
    return zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1


@pytest.mark.parametrize("share_bytes", [ngram_lm.SHARE_BYTES, 300])
def test_lm_scores(spark, texts, share_bytes):
    tok = lambda t: [*TOKEN.findall((t or "").translate(LOWER)), None]
    c = Counter(x for k, t in texts if not held(k) for x in tok(t))
    n, v = sum(c.values()), len(c)
    d = spark.createDataFrame(texts, "doc_id long, text string").withColumn("score", F.lit("old"))
    got = ngram_lm.score(d, share_bytes=share_bytes).collect()
    want = [(k, held(k), len(tok(t)), sum(c[x] > 0 for x in tok(t)), n, sum(log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tok(t))) for k, t in texts]
    order = lambda r: (str(r[0]), r[2], r[5])
    for a, b in zip(sorted((tuple(r) for r in got), key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # held-out texts are likelier than by single words
    assert all(r.score < 0 for r in got)


def test_lm_score_column(spark, texts):
    """Weights and scores from exact counts of bigrams, quantised; a text may differ where the filter errs."""
    from math import log

    end = None
    tok = lambda t: [*TOKEN.findall((t or "").translate(LOWER)), end]
    train = [tok(t) for k, t in texts if not held(k)]
    c = Counter(x for w in train for x in w)
    two = Counter(p for w in train for p in zip([end, *w[:-1]], w, strict=True))
    n, v = sum(c.values()), len(c)
    alone = lambda x: (x + 0.5) / (n + 0.5 * (v + 1))
    read = lambda h, x: min(2 ** (two[h, x].bit_length() - 1), c[h], c[x]) if two[h, x] else 0
    best = {}
    for w in train:
        for h, x in zip([end, *w[:-1]], w, strict=True):
            own = best.setdefault(c[h].bit_length(), [0.0] * len(ngram_lm.GRID))
            for k, mixed in enumerate(ngram_lm.GRID.tolist()):
                own[k] += log((1 - mixed) * max(read(h, x) - 1, 0) / max(c[h] - 1, 1) + mixed * alone(max(c[x] - 1, 0)))
    weight = {level: 1.0 if level < 2 else float(ngram_lm.GRID[int(np.argmax(s))]) for level, s in best.items()}
    want = []
    for k, t in texts:
        w = tok(t)
        total = 0.0
        for h, x in zip([end, *w[:-1]], w, strict=True):
            mixed = weight.get(c[h].bit_length(), 1.0)
            total += log10((1 - mixed) * read(h, x) / max(c[h], 1) + mixed * alone(c[x]))
        want.append((str(k), len(w), total))
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in ngram_lm.score(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    same = [a[:2] == b[:2] and a[2] == pytest.approx(b[2]) for a, b in zip(got, sorted(want), strict=True)]
    assert sum(same) > 0.9 * len(same) and all(a[2] == pytest.approx(b[2], rel=0.1) for a, b in zip(got, sorted(want), strict=True))


def test_lm_probabilities_do_not_exceed_one():
    rng = np.random.default_rng(0)
    c = rng.integers(1, 50, 40)
    model = ngram_lm.Model(int(c.sum()), len(c), np.full(ngram_lm.LEVELS, 0.3))
    pairs = rng.multinomial(c[0], c / c.sum())
    level = np.where(pairs > 0, ngram_lm.level_of(np.maximum(pairs, 1)), 0)
    p = model.probability(c, np.full(len(c), c[0]), level)
    assert 0 < p.sum() <= 1


def test_filter_gives_back_its_levels():
    rng = np.random.default_rng(1)
    h = rng.integers(1, 2**63, 5000).astype(np.uint64)
    counts = rng.integers(1, 1000, 5000)
    bits = ngram_lm.build_filter(h, counts)
    shard = ngram_lm.Shard(1, 0, 1, h[:0], counts[:0], bits, np.array([0]), np.array([8 * len(bits)]))
    found = np.zeros(10000, np.uint8)
    shard.quantised(np.concatenate((h, rng.integers(1, 2**63, 5000).astype(np.uint64))), found)
    assert (found[:5000] >= ngram_lm.level_of(counts)).all() and (found[:5000] == ngram_lm.level_of(counts)).mean() > 0.99 and (found[5000:] > 0).mean() < 0.01


def test_lm_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_lm.score(empty).count() == 0
    only = spark.createDataFrame([(k, "a b") for k in range(40) if held(k)], "doc_id long, text string")
    got = ngram_lm.score(only).collect()
    assert got and all(r.train_tokens == 0 and r.score == 0 for r in got)


def test_quality_against_dictionaries(spark):
    """Counts, ratios, importances and the draw, one n-gram and one text at a time."""
    from math import log, log2, sqrt

    from millrace.llm import textkernel as K

    docs, labels = labelled(spark)
    labels = labels.where("doc_id % 2 = 0 or doc_id % 3 = 0")
    rows = [(r.doc_id, r.text, r.h) for r in docs.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("h")).collect()]
    sample = quality.labelled(labels, "doc_id", "quality", "toxic", quality.LABELLED)
    known = {i: (g, f) for i, g, f in zip(sample.ids.tolist(), sample.good.tolist(), sample.fit.tolist(), strict=True)}
    shape = lambda level: quality.UNIGRAMS + int(K.mix(np.array([quality._TWICE + np.uint64(level)]))[0]) % quality.BIGRAMS
    said = sorted({g for _, t, _ in rows for w in [t.split()] for g in [*((x,) for x in w), *zip(w[:-1], w[1:], strict=True)]})
    raw = [" ".join(g).encode() for g in said]
    one = K.words_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]), K.BLANK, lower=True)
    bucket, at = {}, 0
    for g in said:
        h = one.hash[at : at + len(g)]
        bucket[g] = int(h[0]) % quality.UNIGRAMS if len(g) == 1 else quality.UNIGRAMS + int(K.window_hashes(h, 2)[0]) % quality.BIGRAMS
        at += len(g)
    own, target, total = {}, Counter(), Counter()
    for i, t, _ in rows:
        w = t.split()
        two = list(zip(w[:-1], w[1:], strict=True))
        level = int(log2(1 + 64 * sum(a == b for a, b in two) / len(w)))
        own[i] = {bucket[(x,)] for x in w} | {bucket[g] for g in two} | ({shape(level)} if level else set())
        total.update(own[i])
        if known.get(i) == (True, True):
            target.update(own[i])
    upto, share = 0, None
    for s, n in sorted((target[b] / n, n) for b, n in total.items()):
        upto += n
        if upto >= sum(total.values()) / 2:
            share = s
            break
    value = {}
    for b, n in total.items():
        expected = n * share
        x = log((target[b] + 3) / (expected + 3))
        if abs(target[b] - expected) > 4 * sqrt(1.5 * (expected + 1)) and abs(x) >= 0.7:
            value[b] = round(x * 2**20) / 2**20
    want = {i: sum(value.get(b, 0) for b in own[i]) for i in own}
    held = [(want[i], g) for i, (g, f) in known.items() if not f]
    cost = lambda c: sum(quality.LOSS if g else 0 for x, g in held if x < c) + sum(not g for x, g in held if x >= c)
    values = sorted({x for x, _ in held})
    cut = min([values[0], *((a + b) / 2 for a, b in zip(values[:-1], values[1:], strict=True))], key=cost)
    k = sum(x >= cut for x in want.values())
    noise = quality._noise(np.array([h for *_, h in rows]))
    drawn = {i for _, i in sorted(((want[i] + 0.05 * e, i) for (i, *_), e in zip(rows, noise.tolist(), strict=True)), reverse=True)[:k]}
    got = quality.classify(docs, labels).collect()
    assert {r.doc_id: r.importance for r in got} == pytest.approx(want, abs=1e-9)
    assert {r.doc_id for r in got if r.accepted} == drawn and 0 < len(drawn) < len(rows)

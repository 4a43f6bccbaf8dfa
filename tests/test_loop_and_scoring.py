"""The harness, the loop, plans, acquisition and artifacts: invariants, goldens and edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import controls, evalset, hardware, lineage, loop, planning, scoring, traces
from millrace.sources import files

SPAM = "text string, label string, slice string, ord long"


def _models():
    """Loaders that travel to the workers by value, as this module isn't there."""
    def echo(weights):
        return lambda prompt: prompt.rsplit("\n\nMessage: ", 1)[-1] if weights == "echo" else weights

    def judge(weights):
        return lambda prompt: "1.0" if "Model answer: yes\n" in prompt else "no idea"

    return echo, judge


echo, judge = _models()


def eval_rows(spark):
    return spark.createDataFrame([("FREE spam", "spam", "pos", 0), ("so spam", "spam", "pos", 1), ("hi ham", "ham", "neg", 2), ("ham, not it", "ham", "boundary", 3)], SPAM)


def test_harness_perfect_and_constant_models(spark):
    got = scoring.evaluate(eval_rows(spark), "classification", echo, "echo").first()
    assert (got.f1, got.pos_score, got.neg_score, got.boundary_score, got.n_failures) == (1.0, 1.0, 1.0, 1.0, 0)
    predicted = scoring.predict(eval_rows(spark), "classification", echo, "I say ham")
    got = scoring.score(predicted, "classification").first()
    assert got.per_class == {"ham": pytest.approx(2 / 3), "spam": 0.0}
    assert (got.f1, got.pos_score, got.neg_score, got.n_failures) == (pytest.approx(2 / 3), 0.0, 1.0, 2)  # of equally rare labels the first by name
    assert {r.text for r in scoring.failures(predicted, "classification").collect()} == {"FREE spam", "so spam"}
    unknown = scoring.predict(eval_rows(spark), "classification", echo, "???")
    assert {r.predicted for r in unknown.collect()} == {T.UNKNOWN_LABEL}
    with pytest.raises(ValueError):
        scoring.evaluate(eval_rows(spark), "poetry", echo, "x")


def test_harness_weights_by_row_nulls_and_empty(spark):
    rows = eval_rows(spark).withColumn("w", F.when(F.col("ord") < 2, "spam").otherwise("ham"))
    assert scoring.score(scoring.predict(rows, "classification", echo, F.col("w")), "classification").first().f1 == 1.0
    empty = scoring.evaluate(eval_rows(spark).limit(0), "classification", echo, "x").first()
    assert (empty.f1, empty.pos_score, empty.n_failures) == (0.0, 0.0, 0)
    nulls = spark.createDataFrame([(None, None, "pos", 0), (None, "a", None, 1)], SPAM)
    got = scoring.evaluate(nulls, "classification", echo, "a").first()
    assert got.f1 == pytest.approx(2 / 2) or got.f1 == pytest.approx(1.0)


def test_harness_entities_and_judge(spark):
    span = "array<struct<text:string,type:string>>"
    rows = spark.createDataFrame([("Ann met Bob", [("Ann", "PER"), ("Bob", "PER"), ("Bob", "PER")], "pos", 0), ("none", [], "neg", 1), (None, None, "boundary", 2)], f"text string, entities {span}, slice string, ord long")
    reply = json.dumps([{"text": "Ann", "type": "PER"}, {"text": "x"}])
    got = scoring.evaluate(rows, "NER", echo, reply).first()
    # tp 1 of 2 distinct gold spans, 3 guesses
    assert got.f1 == pytest.approx(2 * (1 / 3) * 0.5 / (1 / 3 + 0.5)) and got.pos_score == 1.0 and got.neg_score == 0.0 and got.n_failures == 3
    answers = spark.createDataFrame([("q", "yes", "pos", 0), ("r", "no", "neg", 1)], SPAM)
    got = scoring.evaluate(answers, "generation", echo, " yes ", judge).first()
    assert (got.f1, got.pos_score, got.per_class) == (1.0, 1.0, {"judge_score": 1.0})
    assert scoring.evaluate(answers, "generation", echo, "nope", judge).first().n_failures == 2
    with pytest.raises(ValueError):
        scoring.predict(answers, "generation", echo, "x")


def test_model_cache_drops_the_first_loaded():
    loaded = []

    def load(w):
        loaded.append(w)
        return lambda p: w

    cache = scoring.ModelCache()
    for w in "aabcadae":
        assert cache.get(load, w)("p") == w
    assert loaded == ["a", "b", "c", "d", "a", "e"] and len(cache.models) == 3


def test_usage_of_calls(spark):
    said = scoring.infer(spark.createDataFrame([("abcdefgh",), (None,)], "text string"), F.col("text"), lambda w: lambda p: scoring.Reply(p, len(p), None), "w", usage=True)
    got = traces.ledger(scoring.usage_events(said, F.current_timestamp())).first()
    assert (got.input_tokens, got.output_tokens, got.llm_calls, got.searches) == (8, 0, 2, 0)


def test_counterexamples_by_task(spark):
    rows = spark.createDataFrame([(1, "a", "x", [("A", "PER")]), (2, "b", "y", []), (3, "c", "x", None)], "pos long, text string, label string, entities array<struct<text:string,type:string>>")
    got = [tuple(r) for r in scoring.synthesize(rows, "pos", 2, echo, "classification", weights=" new ").select("pos", "text", "label", "origin").orderBy("pos", "origin").collect()]
    assert got == [(1, "a", "x", "hard_orig"), (1, "new", "y", "hard_syn"), (2, "b", "y", "hard_orig"), (2, "new", "x", "hard_syn")]
    bad = scoring.synthesize(rows, "pos", 1, echo, "NER", weights="{broken").where("origin = 'hard_syn'").first()
    assert bad.text == "{broken" and bad.entities == []
    good = scoring.synthesize(rows, "pos", 1, echo, "NER", weights='so {"text": "t", "entities": [{"text": "A", "type": "ORG"}, {"text": "B"}]}').where("origin = 'hard_syn'").first()
    assert good.text == "t" and [tuple(e) for e in good.entities] == [("A", "ORG")]
    made = scoring.synthesize(rows, "pos", 1, echo, "generation", weights="wrong").where("origin = 'hard_syn'").first()
    assert (made.prompt, made.response) == ("a", "wrong")
    six = spark.createDataFrame([(1, "t", [(f"e{k}", "T") for k in range(7)])], "pos long, text string, entities array<struct<text:string,type:string>>")
    asked = six.select(scoring.counterexample_prompt(six, "NER", F.lit("")).alias("p")).first().p
    assert '"e4" (T)' in asked and "e5" not in asked
    only = spark.createDataFrame([(1, "a", "x")], "pos long, text string, label string")
    assert {r.label for r in scoring.synthesize(only, "pos", 5, echo, "classification", weights="n").collect()} == {"x"}


def test_curate_rebuild_and_surgical(spark):
    train = spark.createDataFrame([(k, f"free prize number {k * 7919} call {k * 31} now {k * 17}" if k % 4 == 0 else f"hello {k * 104729} how are you {k * 13} doing {k * 3}", "spam" if k % 4 == 0 else "ham") for k in range(400)], "doc_id long, text string, label string")
    held = evalset.build(train.where("doc_id < 200"), "classification", "doc_id")
    failed = held.orderBy("doc_id").limit(5)
    made = loop.curate(train, held, failed, "doc_id", "classification", lambda w: lambda p: p.rsplit("Text: ", 1)[1].split("\n")[0][::-1]).cache()
    origins = {r.origin: r.n for r in made.groupBy("origin").agg(F.count("*").alias("n")).collect()}
    assert set(origins) == {"gold", "hard_orig", "hard_syn"} and origins["gold"] <= controls.gold_budget("classification")
    held_texts = {r.text for r in held.collect()}
    assert not held_texts & {r.text for r in made.collect()}  # failures are evaluation rows: they don't come back
    labels = {r.label: r.n for r in made.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert max(labels.values()) <= 3 * min(labels.values())
    told = loop.curation_counts(made).first()
    assert told.n_gold == origins["gold"] and told.label_dist == labels and told.n_hard_reported == origins["hard_orig"] + origins["hard_syn"]
    more = loop.curate(train, held, train.where("doc_id >= 380"), "doc_id", "classification", lambda w: lambda p: f"made {len(p) * 7} {hash(p)}", "surgical", made.drop("pos"))
    assert more.where("origin = 'hard_orig'").count() > origins["hard_orig"] - 1
    assert loop.curate(train, held, failed, "doc_id", "classification", echo, "hyperparameter", made) is made
    first = loop.sources(failed.drop("slice"), train, "doc_id", 8).orderBy("pos").collect()
    assert [r.pos for r in first] == list(range(1, 9)) and [r.text for r in first[:5]] == [r.text for r in failed.collect()]


def test_decisions_fall_back(spark):
    nodes = spark.createDataFrame([(0.5, 0, '{"intervention": "surgical", "hypothesis": "h"}'), (0.9, 0, "sorry"), (0.99, 0, None), (0.5, 2, None)], "score double, no_improve long, raw string")
    got = [(r.intervention, r.hypothesis[:10], r.next_action) for r in loop.decided(nodes, F.col("raw"), F.lit(0.96)).collect()]
    assert got == [("surgical", "h", "curate"), ("hyperparameter", "(fallback)", "train"), ("surgical", "(fallback)", "terminate"), ("data_rebuild", "(fallback)", "escalate")]


def test_best_config_first_of_equals(spark):
    scored = spark.createDataFrame([(1, 1, 0, "A", 0.7), (1, 1, 1, "B", 0.7), (1, 2, 0, "A", 0.6), (1, 2, 1, "B", 0.8)], "run int, seq int, ord int, config string, f1 double")
    got = loop.evaluated(scored).orderBy("seq").collect()
    assert [(r.best_config, r.parent_iteration, r.no_improve) for r in got] == [("A", None, 0), ("B", 1, 0)]


def test_driven_run_rolls_back_and_stops():
    schedule = [0.62, 0.74, 0.70, 0.85, 0.93, 0.97]
    seen = []

    def score(ref):
        seen.append(ref)
        return schedule[min((len(seen) - 1) // 2, 5)]

    run = loop.Run()
    steps = [s for s, _ in loop.drive(run, lambda r: None, lambda r: {"A": f"a{r.iteration}", "B": f"b{r.iteration}"}, score, increases=9)]
    # A regression counts twice, so it alone reaches the escalation gate, and this run has one model only
    assert steps[-3:] == ["rollback", "iterate", "escalate"] and run.scores == [0.62, 0.74] and run.best == 0.74 and run.best_weights == "a2" and run.action == "terminate"
    assert [n["pruned"] for n in run.dag] == [False, False, True] and [n["parent_iteration"] for n in run.dag] == [None, 1, 2]
    seen.clear()
    run = loop.Run(n_models=2)
    list(loop.drive(run, lambda r: None, lambda r: {"A": f"a{r.iteration}", "B": f"b{r.iteration}"}, score, increases=9))
    assert run.model == 1 and run.scores == [0.85, 0.93, 0.97] and run.best == 0.97 and run.action == "terminate"
    seen.clear()
    run = loop.Run()
    steps = [s for s, _ in loop.drive(run, lambda r: None, lambda r: {"A": "a"}, lambda ref: 0.1 * len(seen) + (seen.append(ref) or 0))]
    assert steps[-1] == "evaluate" and run.best == pytest.approx(0.2)  # the first score of all is a rise, even 0.0
    run = loop.Run(n_models=2)
    steps = [s for s, _ in loop.drive(run, lambda r: None, lambda r: {"A": "a"}, lambda ref: 0.5, most=100)]
    assert steps.count("escalate") == 2 and run.model == 1 and run.action == "terminate"
    assert len(list(loop.drive(loop.Run(), lambda r: None, lambda r: {"A": "a"}, lambda ref: 0.5, most=4))) == 4


def test_plans_and_limits(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(planning.plan(F.lit("nonsense"))) is None and one(planning.plan(F.lit(None).cast("string"))) is None
    assert one(planning.plan(F.lit('{"task_type": "NER", "labels": ["PER"]}'))).labels == ["PER"]
    with pytest.raises(Exception, match="no valid plan"):
        one(planning.plan(F.lit("nonsense"), strict=True))
    got = one(planning.limits(F.lit(None).cast("string")))
    assert (got.storage_mb, got.memory_mb, got.latency_ttft_ms, got.power_watts, got.target_chip) == (1500, 3000, 2000, 5.0, "snapdragon_778g")
    devices = spark.createDataFrame([(1, 500, 1200), (2, 100, 200)], "d int, storage_mb int, memory_mb int")
    assert {r.d: r.model_id for r in planning.start_model(hardware.pool(spark), devices, "d").collect()} == {1: "openbmb/MiniCPM4-0.5B", 2: None}
    assert {r.d: r.model_id for r in planning.start_model(hardware.pool(spark), devices, "d", forced="google/gemma-3-1b-it").collect()} == {1: None, 2: None}


def test_acquired_labels_and_papers(spark):
    body = "word " * 60
    hits = spark.createDataFrame([(k, f"l{k % 8}", f"https://arxiv.org/{'a' if k % 16 == 0 else 'abs'}/{k}", None if k % 2 else "t", body if k % 5 else "short") for k in range(400)], "id long, label string, url string, title string, text string")
    plan = files.planned(hits.select("label").distinct(), spark.createDataFrame([("l0", "about l0")], "label string, query string"), "label")
    assert {r.label: r.query for r in plan.collect()} == {"l0": "about l0", **{f"l{k}": f"l{k} example text" for k in range(1, 6)}}
    got = files.acquired(hits, plan, "id").groupBy("label").count().collect()
    assert len(got) == 6 and all(r["count"] <= 16 for r in got)
    papers = files.acquired_papers(hits, hits.select("label").distinct(), "id")
    assert papers.where("id % 16 = 0").count() == 0 and files.acquired_papers(hits.withColumn("url", F.lit("https://x.org/p")), plan, "id").count() == 0
    assert files.areas(spark).count() == 5 and set(files.T.SKIP_PAPERS) > set(files.T.SKIP_WEB)


def test_artifacts_and_texts(spark, tmp_path):
    dag = spark.createDataFrame([(1, 0.5)], "iteration int, score double")
    where = files.write_artifacts(str(tmp_path), dag=dag, scores=dag.limit(0))
    assert spark.read.json(where["dag"]).first().score == 0.5 and set(where) == {"dag", "scores"}
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(T.unfenced(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}' and one(T.unfenced(F.lit(" plain "))) == "plain"
    assert one(loop.checkpoint_folder(F.lit(3), F.lit("B: full_ft"))) == "iter3_B"
    assert one(loop.trajectory_for(F.lit(None).cast("string"))) == "(no iterations logged yet)"
    failed = spark.createDataFrame([(1, "p", None, [("A", "PER")], None, "x" * 100)], "o long, predicted string, label string, entities array<struct<text:string,type:string>>, response string, prompt string")
    assert loop.failure_summary(failed, "o").first().failures == f'  - predicted=p gold=[{{"text":"A","type":"PER"}}] text={"x" * 80}'
    assert [r.label for r in hardware.default_configs(spark).collect()] == ["A: LoRA r=8", "B: full_ft"]


def test_trace_tools(spark):
    rows = spark.createDataFrame([(1, None, "i", None, None), (2, None, "i", "a", "b")], "trace_id long, ts timestamp, input string, prediction string, corrected_output string")
    got = traces.trace_table(rows, "m", "t", "c")
    assert got.schema.simpleString() == spark.createDataFrame([], traces.TRACE).schema.simpleString()
    assert [r.verdict for r in got.orderBy("trace_id").collect()] == ["pass", "fail"]
    assert traces.query_traces("SELECT count(*) AS n FROM {t}", t=got).first().n == 2
    spans = spark.createDataFrame([(k, [("e", "A")] * 4 + ([("f", "B")] if k == 0 else [])) for k in range(3)], "id long, entities array<struct<text:string,type:string>>")
    assert {r.type: r["count"] for r in traces.entity_type_balance(spans, "id").groupBy("type").count().collect()} == {"A": 3, "B": 1}
    texts = spark.createDataFrame([(1, "red green blue"), (2, "red green blue"), (3, "other words here"), (4, None)], "id long, text string")
    assert [(r.id, r.corrected_id, round(r.cosine, 9)) for r in traces.similar_to(texts.where("id = 1"), texts, "id").collect()] == [(2, 1, 1.0)]
    best = lineage.top_k(spark.createDataFrame([(1, 1, 0.5, False), (1, 2, 0.9, True), (1, 3, 0.7, None)], "run int, iteration int, score double, pruned boolean"), 1).first()
    assert best.iteration == 3


def test_similar_to_in_blocks_and_shards(spark, monkeypatch):
    import math
    import random
    from collections import Counter

    from millrace.operators import tfidf

    monkeypatch.setattr(tfidf, "BLOCK_ENTRIES", 40)
    monkeypatch.setattr(tfidf, "SHARD_WORDS", 30)
    rng = random.Random(4)
    words = [f"W{int(90 * rng.random() ** 3)}" for _ in range(3000)] + ["a\u00a0b", "\u0130x"]
    data = [(k, rng.choice([" ", "\t\n", "\x0b"]).join(rng.choices(words, k=rng.randrange(1, 25)))) for k in range(150)]
    data += [(200, data[0][1]), (201, None), (202, " "), (7, "w1 w2 w2 w95"), (None, data[1][1]), (None, "w1")]
    asked = [r for r in data if r[0] is not None and r[0] % 7 == 0] + [(3, "w1 w2 unknown"), (999, "w1 w2"), (None, "w1")]

    def bags(rows):
        out = {}
        for i, t in rows:
            out.setdefault(i, Counter()).update(x.lower() for x in (t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").split(" ") if x)
        return out

    every, df = bags(data), Counter()
    for b in every.values():
        df.update(b.keys())
    idf = {w: math.log((1 + len(data)) / (1 + df[w])) + 1 for w in df}
    weigh = lambda b: {w: n * idf[w] for w, n in b.items() if w in idf}
    norm = {i: math.sqrt(sum(x * x for x in weigh(b).values())) for i, b in every.items()}
    want = {}
    for q, b in bags(asked).items():
        for i, c in every.items():
            if None not in (q, i) and q != i and norm.get(q) and norm[i]:
                x, y = weigh(b), weigh(c)
                cos = sum(v * y.get(w, 0) for w, v in x.items()) / norm[q] / norm[i]
                if cos >= 0.5:
                    want[i, q] = round(cos, 9)
    frame = lambda rows: spark.createDataFrame(rows, "id long, text string")
    got = {(r.id, r.corrected_id): round(r.cosine, 9) for r in traces.similar_to(frame(asked), frame(data), "id").collect()}
    assert len(want) > 40 and got == want


def test_similar_to_shuffles_little(spark):
    """Before, every word of every row was shuffled several times."""
    import random
    import time

    rng = random.Random(5)
    words = [f"word{k}" for k in range(3000)]
    rows = spark.createDataFrame([(k, " ".join(rng.choices(words, k=300))) for k in range(1000)], "id long, text string")

    def written():
        time.sleep(1)
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()

    before = written()
    assert traces.similar_to(rows.where("id % 50 = 0"), rows, "id").count() == 0
    assert 0 < written() - before < 1_000_000

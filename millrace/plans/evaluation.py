"""Queries of the harness, the loop, planning, acquisition and the trace tools, with their DuckDB SQL.

Language models are stood in for by functions of the prompt, which SQL can repeat.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import evalset, hardware, lineage, loop, planning, scoring, traces
from millrace.plans.catalog import _BINARY, _CHIP, _ENT, _LANG, _POOL, _ROUND, _SCORES, _query, binary_rows, entity_rows, language_rows, scores, usage
from millrace.sources.files import acquired, acquired_papers, planned, table

# ---- models that are functions of their prompt --------------------------------------------

_ANSWERS = (" The Label is EN. ", "champion de", "???", "fr, I think")
_VERDICTS = ("1.0", " 0.5 ", "n/a", "", "0.25")


def labeller(weights: str) -> scoring.Model:
    return lambda prompt: _ANSWERS[len(prompt) % 4]


def tagger(weights: str) -> scoring.Model:
    def say(prompt: str) -> str:
        found = re.search("[A-Z][a-z]+", prompt.split("\n\nText: ", 1)[1])
        return f"Sure: {json.dumps([{'text': found.group(), 'type': 'PER'}])}" if found else "none"

    return say


def answerer(weights: str) -> scoring.Model:
    return lambda prompt: f" {len(prompt) % 7} "


def judge(weights: str) -> scoring.Model:
    return lambda prompt: _VERDICTS[len(prompt) % 5]


def rewriter(weights: str) -> scoring.Model:
    def say(prompt: str) -> str:
        passage = prompt.split("\nPassage: ", 1)[1].rsplit("\n\nReply", 1)[0]
        made = {"text": f"p{len(passage)}", "entities": [{"text": "x", "type": "LOC"}, {"text": "y"}]}
        return f"Here: {json.dumps(made)}" if len(passage) % 2 == 0 else f"no json {len(passage)}"

    return say


def misleader(weights: str) -> scoring.Model:
    return lambda prompt: f"wrong {len(prompt.split('Question: ', 1)[1].rsplit(chr(10) + 'Right answer', 1)[0])}"


def metered(weights: str) -> scoring.Model:
    return lambda prompt: scoring.Reply("ok", len(prompt) // 4, 1)


# ---- harness -------------------------------------------------------------------------------

_SAID = "CASE (length(text) + %d) %% 4 WHEN 0 THEN ' The Label is EN. ' WHEN 1 THEN 'champion de' WHEN 2 THEN '???' ELSE 'fr, I think' END" % len(T.CLASSIFY_PROMPT)
_PREDICTED = f"gl AS (SELECT list_sort(list(DISTINCT label)) AS ls FROM ev), pr AS (SELECT ev.*, coalesce(list_filter(ls, lambda x: contains(lower(trim({_SAID})), lower(x)))[1], '__EXTRACTION_FAILED__') AS predicted FROM ev, gl)"
_CLASSES = "cf AS (SELECT label, count(*) AS support, count(*) FILTER (predicted = label) AS tp, (SELECT count(*) FROM pr y WHERE y.predicted = pr.label) AS guesses FROM pr GROUP BY label), pc AS (SELECT label, CASE WHEN tp = 0 THEN 0.0 ELSE 2 * (tp / guesses) * (tp / support) / (tp / guesses + tp / support) END AS f1 FROM cf)"
_RATES = "coalesce(round(avg((label = predicted)::INT) FILTER (slice = 'pos'), 9), 0) AS pos_score, coalesce(round(avg((label = predicted)::INT) FILTER (slice = 'neg'), 9), 0) AS neg_score, coalesce(round(avg((label = predicted)::INT) FILTER (slice = 'boundary'), 9), 0) AS boundary_score, count(*) FILTER (label <> predicted) AS n_failures"


def _rounded(result):
    return result.select(*[F.round(c, 9).alias(c) for c in ("f1", "pos_score", "neg_score", "boundary_score")], "n_failures")


def _classified(spark, d):
    return scoring.predict(evalset.build(language_rows(spark, d), "classification", "doc_id"), "classification", labeller, "w")


@_query(f"WITH {_ROUND}, {_PREDICTED}, {_CLASSES} SELECT (SELECT round(avg(f1), 9) FROM pc) AS f1, {_RATES} FROM pr")
def harness_classification(spark, d):
    return _rounded(scoring.score(_classified(spark, d), "classification"))


@_query(f"WITH {_ROUND}, {_PREDICTED}, {_CLASSES} SELECT label, round(f1, 9) AS f1 FROM pc")
def harness_per_class(spark, d):
    return scoring.score(_classified(spark, d), "classification").select(F.explode("per_class").alias("label", "f1")).withColumn("f1", F.round("f1", 9))


@_query(f"WITH {_ROUND}, {_PREDICTED} SELECT doc_id, label, predicted FROM pr WHERE label <> predicted")
def harness_failures(spark, d):
    return scoring.failures(_classified(spark, d), "classification").select("doc_id", "label", "predicted")


_BINARY_SET = f"""{_BINARY}, nb AS (SELECT label, count(*) AS n, min(doc_id) AS seen FROM b GROUP BY label)"""


@_query(f"""WITH {_BINARY_SET}, pr AS (SELECT b.*, CASE doc_id % 4 WHEN 0 THEN 'pos' WHEN 1 THEN 'neg' ELSE 'boundary' END AS slice, coalesce(list_filter((SELECT list_sort(list(label)) FROM nb), lambda x: contains(lower(trim({_SAID})), lower(x)))[1], '__EXTRACTION_FAILED__') AS predicted FROM b), {_CLASSES}
SELECT (SELECT round(f1, 9) FROM pc JOIN nb USING (label) ORDER BY n, label LIMIT 1) AS f1, {_RATES} FROM pr""")
def harness_binary(spark, d):
    r = F.col("doc_id") % 4
    rows = binary_rows(spark, d).withColumn("slice", F.when(r == 0, "pos").when(r == 1, "neg").otherwise("boundary"))
    return _rounded(scoring.evaluate(rows, "classification", labeller, "w"))


_THIRDS = "(SELECT doc_id, CASE WHEN k <= 40 THEN 'pos' WHEN k <= 80 THEN 'neg' ELSE 'boundary' END AS slice FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k FROM documents) WHERE k <= 100)"


@_query(f"""WITH {_ENT}, ev AS (SELECT e.*, slice, regexp_extract(text, '[A-Z][a-z]+') AS w FROM e JOIN {_THIRDS} USING (doc_id)),
q AS (SELECT slice, list_distinct(entities) AS g, CASE WHEN coalesce(w, '') = '' THEN [] ELSE [{{'text': w, 'type': 'PER'}}] END AS p FROM ev),
c AS (SELECT sum(len(list_intersect(g, p)))::BIGINT AS tp, sum(len(p))::BIGINT AS np, sum(len(g))::BIGINT AS ng FROM q), pr AS (SELECT slice, len(g) > 0 AS label, len(p) > 0 AS predicted, g, p FROM q)
SELECT (SELECT CASE WHEN tp = 0 THEN 0.0 ELSE round(2 * (tp / np) * (tp / ng) / (tp / np + tp / ng), 9) END FROM c) AS f1, {_RATES.replace('FILTER (label <> predicted)', 'FILTER (len(list_intersect(g, p)) <> len(g) OR len(p) <> len(g))')} FROM pr""")
def harness_ner(spark, d):
    return _rounded(scoring.evaluate(evalset.build(entity_rows(spark, d), "NER", "doc_id"), "NER", tagger, "w"))


_JUDGED = f"(length(text) + length(label) + 1 + {sum(map(len, T.JUDGE_PROMPT))}) % 5"


@_query(f"""WITH {_LANG}, pr AS (SELECT slice, CASE {_JUDGED} WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 4 THEN 0.25 ELSE 0.0 END::DOUBLE AS s FROM l JOIN {_THIRDS} USING (doc_id)), r AS (SELECT slice, s, s >= 0.5 AS predicted, true AS label FROM pr)
SELECT round(avg(s), 9) AS f1, {_RATES} FROM r""")
def harness_generation(spark, d):
    return _rounded(scoring.evaluate(evalset.build(language_rows(spark, d), "generation", "doc_id"), "generation", answerer, "w", judge))


@_query("SELECT round_even(sum(t) * 3 / 1e6 + sum(o) * 15 / 1e6, 9) AS usd, sum(t)::BIGINT AS input_tokens, sum(o)::BIGINT AS output_tokens, count(*) AS llm_calls FROM (SELECT (length(text) // 4)::BIGINT AS t, 1 AS o FROM documents)")
def metered_inference(spark, d):
    said = scoring.infer(table(spark, d, "documents").select("doc_id", "text"), F.col("text"), metered, "w", usage=True)
    got = traces.ledger(scoring.usage_events(said, F.current_timestamp()))
    return got.select(F.round(traces.cost(F.col("input_tokens"), F.col("output_tokens"), F.lit(0)), 9).alias("usd"), "input_tokens", "output_tokens", "llm_calls")


# ---- counterexamples and curation ------------------------------------------------------------


@_query("""WITH r AS (SELECT doc_id, text, length(text) AS n FROM documents ORDER BY doc_id LIMIT 60)
SELECT doc_id, 'hard_orig' AS origin, md5(text) AS text_md5, len(regexp_extract_all(text, '[A-Z][a-z]+'))::BIGINT AS n_entities FROM r
UNION ALL SELECT doc_id, 'hard_syn', md5(CASE WHEN n % 2 = 0 THEN 'p' || n ELSE 'no json ' || n END), (n % 2 = 0)::BIGINT FROM r""")
def counterexamples_ner(spark, d):
    made = scoring.synthesize(entity_rows(spark, d), "doc_id", 60, rewriter, "NER")
    return made.select("doc_id", "origin", F.md5("text").alias("text_md5"), F.size("entities").cast("bigint").alias("n_entities"))


@_query("""WITH r AS (SELECT doc_id, text, lang FROM documents ORDER BY doc_id LIMIT 60)
SELECT doc_id, 'hard_orig' AS origin, md5(text) AS prompt_md5, lang AS response FROM r UNION ALL SELECT doc_id, 'hard_syn', md5(text), 'wrong ' || length(text) FROM r""")
def counterexamples_generation(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("text").alias("prompt"), F.col("lang").alias("response"))
    made = scoring.synthesize(rows, "doc_id", 60, misleader, "generation")
    return made.select("doc_id", "origin", F.md5("prompt").alias("prompt_md5"), "response")


@_query(f"""WITH d AS (SELECT doc_id, text, lang FROM documents), ev AS (SELECT text FROM d JOIN {_THIRDS} USING (doc_id)), fl AS (SELECT * FROM d WHERE doc_id % 9 = 0 ORDER BY doc_id LIMIT 350),
gold AS (SELECT doc_id, text, lang FROM d WHERE text NOT IN (SELECT text FROM ev) ORDER BY md5('42:' || doc_id), doc_id LIMIT 650),
src AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY k, doc_id) AS pos FROM (SELECT 0 AS k, * FROM fl UNION ALL (SELECT 1 AS k, * FROM d ORDER BY doc_id LIMIT 350))) WHERE pos <= 350),
al AS (SELECT 'gold' AS origin, text AS prompt, lang AS response FROM gold UNION ALL SELECT 'hard_orig', text, lang FROM src WHERE text NOT IN (SELECT text FROM ev) UNION ALL SELECT 'hard_syn', text, 'wrong ' || length(text) FROM src),
m AS (SELECT length(prompt) AS n FROM (SELECT *, row_number() OVER (ORDER BY length(prompt)) AS rn, count(*) OVER () AS c FROM al) WHERE rn = c // 2 + 1)
SELECT origin, count(*) AS n, sum(length(prompt))::BIGINT AS chars, min(md5(response || prompt)) AS least FROM al WHERE length(prompt) <= 3 * (SELECT n FROM m) GROUP BY origin""")
def curate_generation(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", F.col("text").alias("prompt"), F.col("lang").alias("response"))
    held = evalset.build(rows, "generation", "doc_id")
    made = loop.curate(rows, held, rows.where("doc_id % 9 = 0"), "doc_id", "generation", misleader)
    return made.groupBy("origin").agg(F.count("*").alias("n"), F.sum(F.length("prompt")).cast("bigint").alias("chars"), F.min(F.md5(F.concat("response", "prompt"))).alias("least"))


@_query("""WITH o AS (SELECT lang AS label, CASE WHEN doc_id % 20 < 13 THEN 'gold' WHEN doc_id % 2 = 0 THEN 'hard_orig' ELSE 'hard_syn' END AS origin FROM documents)
SELECT label, n, (SELECT count(*) FROM o WHERE origin = 'gold') AS n_gold, (SELECT count(*) FROM o WHERE origin = 'hard_orig') AS n_hard_orig, (SELECT count(*) FROM o WHERE origin = 'hard_syn') AS n_hard_syn, (SELECT least(700, count(*)) FROM o)::BIGINT AS n_hard_reported FROM (SELECT label, count(*) AS n FROM o GROUP BY label)""")
def curation_counts(spark, d):
    origin = F.when(F.col("doc_id") % 20 < 13, "gold").when(F.col("doc_id") % 2 == 0, "hard_orig").otherwise("hard_syn")
    got = loop.curation_counts(table(spark, d, "documents").select(F.col("lang").alias("label"), origin.alias("origin")), 700)
    return got.select(F.explode("label_dist").alias("label", "n"), "n_gold", "n_hard_orig", "n_hard_syn", "n_hard_reported")


# ---- the loop ----------------------------------------------------------------------------------

_PAIRED = f"{_SCORES}, c AS (SELECT run, seq // 2 AS seq, seq % 2 AS ord, CASE WHEN seq % 2 = 0 THEN 'A' ELSE 'B' END AS config, score FROM s), bc AS (SELECT run, seq, config, score FROM c QUALIFY row_number() OVER (PARTITION BY run, seq ORDER BY score DESC, ord) = 1)"
_NODES = f"{_PAIRED}, nx AS (SELECT *, row_number() OVER w AS iteration, max(score) OVER (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM bc WINDOW w AS (PARTITION BY run ORDER BY seq)), ni AS (SELECT *, sum((before IS NULL OR score > before)::INT) OVER (PARTITION BY run ORDER BY seq) AS island FROM nx), nodes AS (SELECT *, row_number() OVER (PARTITION BY run, island ORDER BY seq) - 1 AS no_improve FROM ni)"


def _scored(spark, d):
    s = scores(spark, d)
    return s.select("run", F.floor(F.col("seq") / 2).alias("seq"), (F.col("seq") % 2).alias("ord"), F.when(F.col("seq") % 2 == 0, "A").otherwise("B").alias("config"), F.col("score").alias("f1"))


@_query(f"WITH {_NODES} SELECT run, seq, iteration::BIGINT AS iteration, lag(iteration) OVER (PARTITION BY run ORDER BY seq)::BIGINT AS parent_iteration, config AS best_config, score, CASE WHEN score < 0.80 THEN 'data_rebuild' WHEN score < 0.95 THEN 'hyperparameter' ELSE 'surgical' END AS intervention, no_improve, CASE config WHEN 'A' THEN 8 END::INT AS lora_rank FROM nodes")
def evaluate_nodes(spark, d):
    configs = spark.createDataFrame([("A", 8, 2e-4, 3, 8)], "config string, lora_rank int, learning_rate double, nr_epochs int, batch_size int")
    got = loop.evaluated(_scored(spark, d), configs)
    return got.select("run", "seq", F.col("iteration").cast("bigint").alias("iteration"), F.col("parent_iteration").cast("bigint").alias("parent_iteration"), "best_config", "score", "intervention", "no_improve", F.col("pi.H.lora_rank").alias("lora_rank"))


_FALL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in loop.FALLBACK.items())


@_query(f"""WITH {_NODES}, dc AS (SELECT *, CASE WHEN score < 0.80 THEN 'data_rebuild' WHEN score < 0.95 THEN 'hyperparameter' ELSE 'surgical' END AS band FROM nodes),
iv AS (SELECT *, CASE seq % 5 WHEN 0 THEN 'surgical' WHEN 1 THEN 'hyperparameter' ELSE band END AS intervention FROM dc)
SELECT run, seq, intervention, CASE seq % 5 WHEN 0 THEN 'why ' || seq WHEN 1 THEN '' ELSE CASE band {_FALL} END END AS hypothesis, CASE WHEN seq % 5 = 0 THEN 'short texts' ELSE '' END AS pattern,
  CASE WHEN score >= 0.99 THEN 'terminate' WHEN no_improve >= 2 THEN 'escalate' WHEN intervention = 'hyperparameter' THEN 'train' ELSE 'curate' END AS next_action FROM iv""")
def iterate_decisions(spark, d):
    r = F.col("seq") % 5
    raw = F.when(r == 0, F.concat(F.lit('```json\n{"intervention": "surgical", "hypothesis": "why '), F.col("seq").cast("string"), F.lit('", "targeted_patterns": "short texts"}\n```'))).when(r == 1, '{"intervention": "hyperparameter", "hyperparams": {"lora_rank": 8}}').when(r == 2, '{"intervention": "prayer"}').when(r == 3, "I can't say")
    return loop.decided(loop.evaluated(_scored(spark, d)), raw, F.lit(0.99)).select("run", "seq", "intervention", "hypothesis", "pattern", "next_action")


_DEVICES = f"{_POOL}, dv AS (SELECT s_suppkey, 200 + s_suppkey * 15 AS mb FROM supplier), ft AS (SELECT s_suppkey, pool.* FROM dv JOIN pool ON int4_size_mb <= mb AND peak_memory_mb <= mb)"


def _devices(spark, d):
    mb = 200 + F.col("s_suppkey") * 15
    k = (F.col("s_suppkey") % len(hardware.POOL)).cast("int")
    return table(spark, d, "supplier").select("s_suppkey", mb.alias("storage_mb"), mb.alias("memory_mb"), F.element_at(F.array(*[F.lit(m[0]) for m in hardware.POOL]), k + 1).alias("model_id"))


@_query(f"WITH {_DEVICES} SELECT s_suppkey, model_id FROM supplier LEFT JOIN (SELECT s_suppkey, model_id FROM ft QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY tier, int4_size_mb, pos) = 1) USING (s_suppkey)")
def start_models(spark, d):
    return planning.start_model(hardware.pool(spark), _devices(spark, d), "s_suppkey")


@_query(f"WITH {_DEVICES}, nm AS (SELECT s_suppkey, pos, lead(model_id) OVER (PARTITION BY s_suppkey ORDER BY tier, int4_size_mb, pos) AS next_model FROM ft) SELECT s_suppkey, next_model, CASE WHEN next_model IS NULL THEN 'terminate' ELSE 'curate' END AS next_action FROM supplier LEFT JOIN nm ON nm.s_suppkey = supplier.s_suppkey AND nm.pos = supplier.s_suppkey % 10".replace("SELECT s_suppkey, next_model, CASE", "SELECT supplier.s_suppkey, next_model, CASE"))
def escalation(spark, d):
    return planning.escalate(_devices(spark, d), hardware.pool(spark), "s_suppkey").select("s_suppkey", "next_model", "next_action")


@_query(f"""WITH {_SCORES}, b AS (SELECT *, coalesce(max(score) OVER (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before FROM s), r AS (SELECT *, (score > greatest(before, -1) + 1e-9)::INT AS rose, row_number() OVER (PARTITION BY run ORDER BY seq) AS step FROM b),
u AS (SELECT *, sum(rose) OVER (PARTITION BY run ORDER BY seq) AS increases FROM r) SELECT run, seq, step, increases::BIGINT AS increases FROM u WHERE increases - rose < 3 AND step <= 40""")
def steps_until_stop(spark, d):
    return loop.steps_until_stop(scores(spark, d)).select("run", "seq", "step", "increases")


@_query(f"WITH {_NODES} SELECT run, seq, CASE WHEN score >= 0.96 THEN 'promote' WHEN no_improve >= 2 THEN 'plateau' WHEN seq * 2 >= 1500 THEN 'turns exhausted' WHEN seq % 3 = 0 THEN 'capacity ceiling' END AS reason FROM nodes")
def convergence_rules(spark, d):
    got = loop.evaluated(_scored(spark, d))
    return got.select("run", "seq", loop.convergence(F.col("score"), F.col("no_improve"), F.col("seq") * 2, F.col("seq") % 3).alias("reason"))


@_query(f"WITH {_SCORES} SELECT run, seq AS iteration, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY score DESC, seq) AS rank FROM s WHERE NOT pruned) WHERE rank <= 3")
def top_k_nodes(spark, d):
    return lineage.top_k(scores(spark, d)).select("run", "iteration", "score", F.col("rank").cast("bigint").alias("rank"))


@_query(f"WITH {_SCORES}, k AS (SELECT run, seq % 4 AS branch, seq, score FROM s WHERE NOT pruned QUALIFY row_number() OVER (PARTITION BY run, seq % 4 ORDER BY score DESC, seq) <= 2) SELECT x.run, x.seq AS a, y.seq AS b, round(x.score - y.score, 6) AS gain FROM k x JOIN k y ON x.run = y.run AND x.branch <> y.branch AND (x.score > y.score OR (x.score = y.score AND x.seq < y.seq))")
def fusion_pairs(spark, d):
    got = lineage.fusions(scores(spark, d).withColumn("branch", F.col("seq") % 4), 2)
    return got.withColumn("gain", F.round("gain", 6))


@_query("SELECT p_partkey, 'iter' || p_size || '_' || CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS folder, CASE WHEN p_partkey % 2 = 0 THEN 'A: LLM-hp r=8' ELSE 'B: LoRA r=None' END || ' lr=2e-04 ep=' || p_size AS label FROM part")
def checkpoint_folders(spark, d):
    even = F.col("p_partkey") % 2 == 0
    label = hardware.config_label(F.when(even, "A").otherwise("B"), F.when(even, 8), F.lit(2e-4), F.col("p_size"))
    return table(spark, d, "part").select("p_partkey", loop.checkpoint_folder(F.col("p_size"), label).alias("folder"), label.alias("label"))


@_query(f"""WITH {_POOL}, s AS (SELECT s_suppkey, 200 + s_suppkey * 15 AS mb, {_CHIP} AS chip FROM supplier), x AS (SELECT *, CASE chip WHEN 'snapdragon_660' THEN tok_s_660 WHEN 'snapdragon_8gen3' THEN tok_s_8gen3 ELSE tok_s_778g END::DOUBLE AS tok_s FROM pool, s)
SELECT s_suppkey, model_id, '- Storage: ' || int4_size_mb || 'MB vs S_max=' || mb || 'MB — ' || CASE WHEN int4_size_mb <= mb THEN 'PASS' ELSE 'FAIL' END || chr(10) || '- Memory: ' || peak_memory_mb || 'MB vs M_max=' || mb || 'MB — ' || CASE WHEN peak_memory_mb <= mb THEN 'PASS' ELSE 'FAIL' END
  || chr(10) || '- Latency: ' || round_even(1000 / tok_s, 0)::BIGINT || 'ms vs L_max=100ms (' || tok_s || ' tok/s on ' || chip || ') — ' || CASE WHEN 1000 / tok_s <= 100 THEN 'PASS' ELSE 'FAIL' END || chr(10) || '- Power: not measured — PASS' AS report FROM x""")
def hardware_report(spark, d):
    k = F.col("s_suppkey") % 4
    chip = F.when(k == 0, "snapdragon_660").when(k == 1, "snapdragon_778g").when(k == 2, "snapdragon_8gen3").otherwise("other")
    pairs = table(spark, d, "supplier").select("s_suppkey", (200 + F.col("s_suppkey") * 15).alias("mb"), chip.alias("chip")).crossJoin(F.broadcast(hardware.pool(spark)))
    named = pairs.withColumn("model_id", F.struct("s_suppkey", "model_id", "mb", "chip", "int4_size_mb", "peak_memory_mb"))
    got = hardware.check(named, F.col("mb"), F.col("mb"), F.lit(100), F.col("chip")).select("model_id.*", "storage_pass", "memory_pass", "tok_s", "ttft_ms", "latency_pass", "power_pass")
    return got.select("s_suppkey", "model_id", hardware.pass_lines(got, F.col("mb"), F.col("mb"), F.lit(100), F.col("chip")).alias("report"))


@_query(f"WITH {_ROUND}, {_PREDICTED} SELECT string_agg('  - predicted=' || predicted || ' gold=' || label || ' text=' || left(text, 80), chr(10) ORDER BY doc_id) AS failures FROM (SELECT * FROM pr WHERE label <> predicted ORDER BY doc_id LIMIT 10)")
def failure_lines(spark, d):
    return loop.failure_summary(scoring.failures(_classified(spark, d), "classification"), "doc_id")


# ---- plans, devices and acquisition --------------------------------------------------------------


@_query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'classification' WHEN 1 THEN 'NER' WHEN 2 THEN 'generation' END AS task_type, CASE p_partkey % 5 WHEN 0 THEN 'spam' WHEN 1 THEN 'task' WHEN 2 THEN 'task' END AS task_name,
  CASE p_partkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 0 END::BIGINT AS n_labels, CASE p_partkey % 5 WHEN 0 THEN 'q1' END AS first_query, CASE p_partkey % 5 WHEN 0 THEN 0.9 WHEN 1 THEN 0.96 WHEN 2 THEN 0.96 END::DOUBLE AS stop_threshold FROM part""")
def task_plans(spark, d):
    r = F.col("p_partkey") % 5
    raw = F.when(r == 0, '```json\n{"task_type": "classification", "task_name": "spam", "labels": ["a", "b"], "exa_queries": {"a": "q1"}, "stop_threshold": 0.9}\n```').when(r == 1, 'Sure: {"task_type": "NER"} there').when(r == 2, '{"task_type": "generation", "stop_threshold": "high"}').when(r == 3, '{"task_type": "poetry"}').otherwise("no idea")
    p = planning.plan(raw)
    return table(spark, d, "part").select("p_partkey", p.alias("p")).select("p_partkey", "p.task_type", "p.task_name", F.when(F.col("p").isNotNull(), F.size("p.labels")).cast("bigint").alias("n_labels"), F.try_element_at("p.queries", F.lit("a")).alias("first_query"), "p.stop_threshold")


@_query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 1200 ELSE 1500 END::INT AS storage_mb, CASE p_partkey % 3 WHEN 0 THEN 100 + p_size ELSE 3000 END::INT AS memory_mb, CASE p_partkey % 3 WHEN 0 THEN 1999 ELSE 2000 END::INT AS latency_ttft_ms, CASE p_partkey % 3 WHEN 0 THEN 4.5 ELSE 5.0 END::DOUBLE AS power_watts,
  CASE p_partkey % 3 WHEN 0 THEN 'snapdragon_660' ELSE 'snapdragon_778g' END AS target_chip FROM part""")
def device_limits(spark, d):
    r = F.col("p_partkey") % 3
    raw = F.when(r == 0, F.concat(F.lit('{"storage_budget_mb": 1200, "usable_ram_mb": '), (F.col("p_size") + 100).cast("string"), F.lit(', "latency_ttft_ms": 1999.9, "power_watts": 4.5, "reference_chip": "snapdragon_660"}'))).when(r == 1, '{"device": "x", "reference_chip": "potato"}').otherwise("search failed")
    return table(spark, d, "part").select("p_partkey", planning.limits(raw).alias("x")).select("p_partkey", "x.*")


_HITS = "h AS (SELECT doc_id, source AS label, 'https://' || CASE WHEN doc_id % 2 = 0 THEN 'arxiv.org' ELSE 'x.org' END || CASE doc_id % 7 WHEN 0 THEN '/list/' WHEN 1 THEN '/a/' ELSE '/p/' END || doc_id AS url, CASE WHEN doc_id % 4 > 0 THEN lang END AS title, text FROM documents)"


def _found(spark, d):
    r = F.col("doc_id") % 7
    url = F.concat(F.lit("https://"), F.when(F.col("doc_id") % 2 == 0, "arxiv.org").otherwise("x.org"), F.when(r == 0, "/list/").when(r == 1, "/a/").otherwise("/p/"), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", F.col("source").alias("label"), url.alias("url"), F.when(F.col("doc_id") % 4 > 0, F.col("lang")).alias("title"), "text")


_TRIMMED = "replace(trim(text, ' ' || chr(10) || chr(9) || chr(13)), chr(10), ' ')"


@_query(f"WITH {_HITS}, lb AS (SELECT DISTINCT source AS label FROM documents ORDER BY label LIMIT 6), f AS (SELECT h.* FROM h SEMI JOIN lb USING (label) QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) <= 16) SELECT doc_id, label, left(coalesce(title, '') || '. ' || {_TRIMMED}, 700) AS text FROM f WHERE length({_TRIMMED}) >= 180 AND NOT contains(url, '/list/')")
def web_acquisition(spark, d):
    found = _found(spark, d)
    plan = planned(found.select("label").distinct(), spark.createDataFrame([], "label string, query string"), "label")
    return acquired(found, plan, "doc_id").select("doc_id", "label", "text")


@_query(f"WITH {_HITS}, f AS (SELECT h.* FROM h QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) <= 20) SELECT doc_id, label, left(coalesce(title, '') || '. ' || {_TRIMMED}, 700) AS text FROM f WHERE length({_TRIMMED}) >= 200 AND contains(url, 'arxiv.org') AND NOT contains(url, '/list/') AND NOT contains(url, 'arxiv.org/a/')")
def paper_acquisition(spark, d):
    found = _found(spark, d)
    return acquired_papers(found, found.select("label").distinct(), "doc_id").select("doc_id", "label", "text")


@_query(f"WITH {_HITS}, f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) <= 3) SELECT label, string_agg('- ' || left(coalesce(title, ''), 80) || ': ' || left(text, 300), chr(10) ORDER BY doc_id) AS snippets FROM f GROUP BY label")
def search_snippets(spark, d):
    return planning.snippets(_found(spark, d), "label", "doc_id")


# ---- traces --------------------------------------------------------------------------------------


@_query("WITH o AS (SELECT user_id AS checkpoint, event_id FROM events WHERE event_id % 4 > 0), n AS (SELECT event_id FROM events WHERE event_id % 11 = 0), c AS (SELECT user_id AS checkpoint, (SELECT count(*) FROM o JOIN n USING (event_id) WHERE o.checkpoint = e.user_id) AS n FROM (SELECT DISTINCT user_id FROM events) e) SELECT count(*) AS checkpoints, max(n) AS worst, max(n) <= 2 AS accepted FROM c")
def checkpoint_gate(spark, d):
    e = table(spark, d, "events")
    return traces.checkpoint_gate(e.select("event_id", F.col("user_id").alias("checkpoint"), (F.col("event_id") % 4 > 0).alias("ok")), e.select("event_id", (F.col("event_id") % 11 > 0).alias("ok")), "event_id")


@_query("WITH o AS (SELECT CASE WHEN doc_id % 20 < 11 THEN 'gold' WHEN doc_id % 20 < 17 THEN 'hard' ELSE 'replay' END AS origin FROM documents), c AS (SELECT origin, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM o) AS percent FROM o GROUP BY origin) SELECT origin, n, round(percent::DOUBLE, 6) AS percent, CASE origin WHEN 'gold' THEN percent BETWEEN 40 AND 60 WHEN 'hard' THEN percent BETWEEN 25 AND 35 ELSE percent BETWEEN 10 AND 20 END AS fits FROM c")
def composition_check(spark, d):
    k = F.col("doc_id") % 20
    rows = table(spark, d, "documents").select(F.when(k < 11, "gold").when(k < 17, "hard").otherwise("replay").alias("origin"))
    return traces.composition_check(rows).withColumn("percent", F.round("percent", 6))


def _traces(spark, d):
    e = table(spark, d, "events")
    rows = e.select(F.col("event_id").alias("trace_id"), "ts", F.col("props").alias("input"), F.col("event_type").alias("prediction"), F.when(F.col("event_id") % 5 > 0, F.col("event_type")).when(F.col("event_id") % 2 > 0, "other").alias("corrected_output"))
    return traces.trace_table(rows, "m", "judge {input}", "equal")


_LOGGED = "tr AS (SELECT event_id AS trace_id, event_type AS prediction, CASE WHEN event_id % 5 > 0 THEN event_type WHEN event_id % 2 > 0 THEN 'other' END AS corrected_output, value FROM events), tv AS (SELECT *, CASE WHEN prediction IS NOT DISTINCT FROM corrected_output THEN 'pass' ELSE 'fail' END AS verdict FROM tr)"


@_query(f"WITH {_LOGGED} SELECT trace_id, verdict, CASE WHEN verdict = 'pass' THEN 'equal' ELSE 'expected ' || coalesce(corrected_output, 'nothing') END AS judge_reasoning, 'judge {{input}}' AS template FROM tv")
def trace_log(spark, d):
    return _traces(spark, d).select("trace_id", "verdict", "judge_reasoning", F.col("judge_metadata.prompt_template").alias("template"))


@_query(f"WITH {_LOGGED} SELECT prediction, verdict, count(*) AS n FROM tv GROUP BY ALL")
def query_traces(spark, d):
    return traces.query_traces("SELECT prediction, verdict, count(*) AS n FROM {traces} GROUP BY prediction, verdict", traces=_traces(spark, d))


@_query("SELECT event_type AS category, count(*) AS n, count(*) FILTER (value > 10) AS external_n, CASE WHEN 2 * count(*) FILTER (value > 10) > count(*) THEN 'external' ELSE 'fixable' END AS kind FROM events WHERE event_id % 4 = 0 GROUP BY 1")
def failure_categories(spark, d):
    failed = table(spark, d, "events").where("event_id % 4 = 0").select(F.col("event_type").alias("category"), (F.col("value") > 10).alias("external"))
    return traces.failure_categories(failed, "category", "external")


@_query(f"WITH {_ENT}, sp AS (SELECT doc_id, unnest(range(0, len(entities))) AS place, unnest(entities) AS s FROM e), r AS (SELECT doc_id, place, s['text'] AS text, s['type'] AS type, row_number() OVER (PARTITION BY s['type'] ORDER BY doc_id, place) AS rn FROM sp) SELECT type, count(*) AS n, md5(string_agg(text, ' ' ORDER BY doc_id, place)) AS texts_md5 FROM r WHERE rn <= 3 * (SELECT min(n) FROM (SELECT count(*) AS n FROM r WHERE length(text) > 9 OR type = 'ORG' GROUP BY type)) AND (length(text) > 9 OR type = 'ORG') GROUP BY type".replace("r AS (SELECT doc_id, place, s['text'] AS text, s['type'] AS type, row_number() OVER (PARTITION BY s['type'] ORDER BY doc_id, place) AS rn FROM sp)", "r AS (SELECT doc_id, place, s['text'] AS text, s['type'] AS type, row_number() OVER (PARTITION BY s['type'] ORDER BY doc_id, place) AS rn FROM sp WHERE length(s['text']) > 9 OR s['type'] = 'ORG')"))
def entity_type_balance(spark, d):
    rows = entity_rows(spark, d).withColumn("entities", F.filter("entities", lambda s: (F.length(s.text) > 9) | (s.type == "ORG")))
    got = traces.entity_type_balance(rows, "doc_id")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "place", "text"))), lambda x: x.text), " ")
    return got.groupBy("type").agg(F.count("*").alias("n"), F.md5(joined).alias("texts_md5"))


@_query(r"""WITH t AS (SELECT doc_id AS id, unnest(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')) AS w FROM documents), c AS (SELECT id, w, count(*) AS tf FROM t GROUP BY ALL), f AS (SELECT w, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY w),
x AS (SELECT id, w, tf * idf AS x FROM c JOIN f USING (w)), n AS (SELECT id, sqrt(sum(x * x)) AS norm FROM x GROUP BY id), s AS (SELECT a.id AS doc_id, b.id AS corrected_id, sum(a.x * b.x) AS dot FROM x a JOIN x b USING (w) WHERE b.id % 50 = 0 AND a.id <> b.id GROUP BY ALL)
SELECT doc_id, corrected_id, round(dot / (m.norm * k.norm), 6) AS cosine FROM s JOIN n m ON m.id = doc_id JOIN n k ON k.id = corrected_id WHERE dot / (m.norm * k.norm) >= 0.5""")
def correction_propagation(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text")
    return traces.similar_to(rows.where("doc_id % 50 = 0"), rows, "doc_id").withColumn("cosine", F.round("cosine", 6))


@_query("WITH u AS (SELECT user_id, event_id % 3 AS r, event_id FROM events), g AS (SELECT user_id, coalesce(sum(event_id % 1000) FILTER (r > 0), 0) * 3 + coalesce(sum(event_id % 200) FILTER (r > 0), 0) * 15 + count(*) FILTER (r = 0) * 5000 AS micro FROM u GROUP BY user_id) SELECT user_id, (micro // 100 + CASE WHEN micro % 100 > 50 OR (micro % 100 = 50 AND micro // 100 % 2 = 1) THEN 1 ELSE 0 END) / 10000 AS usd FROM g")
def ledger_dollars(spark, d):
    return traces.ledger(usage(spark, d), "user_id").select("user_id", F.col("usd").cast("double").alias("usd"))

"""All queries of the library outside the optional subpackage, by name, and their DuckDB SQL.

The driver's tables stand in for the workload's: documents with their language as label,
documents joined to labels as a binary task, capitalised words as entities, pages as
search hits, events as traces and usage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import controls, evalset, hardware, lineage, metrics, traces
from millrace.sources.files import documents_of, evaluation_json, hits, search_report, table, tsv_rows, with_query
from millrace.streaming import costs

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str | Callable[[], str]] = {}


def _query(sql: str | Callable[[], str]):
    """Registers a query with its SQL; a function, if parts of the SQL are defined further down."""
    def add(f):
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import millrace.plans.evaluation  # noqa: F401  (its queries register themselves here)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    import millrace.plans.evaluation  # noqa: F401

    return {name: sql if isinstance(sql, str) else sql() for name, sql in _SQL.items()}


# ---- the tables as the workload's inputs ----------------------------------------------


def binary_rows(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return table(spark, d, "documents").select("doc_id", "text").join(labels, "doc_id")


def language_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", F.col("lang").alias("label"))


_BINARY = "b AS (SELECT doc_id, text, quality::VARCHAR AS label FROM documents JOIN labels USING (doc_id))"
_LANG = "l AS (SELECT doc_id, text, lang AS label FROM documents)"

#: A model's stand-in: right but for every fifth id, where the next label by name (or the same) is said.
_GUESS_SQL = "p AS (SELECT doc_id, label, CASE WHEN doc_id % 5 = 0 THEN coalesce((SELECT min(x.label) FROM (SELECT DISTINCT label FROM {0}) x WHERE x.label <> {0}.label), label) ELSE label END AS predicted FROM {0})"


def guessed(rows: DataFrame) -> DataFrame:
    labels = rows.agg(F.array_sort(F.collect_set("label")).alias("labels"))
    other = F.coalesce(F.try_element_at(F.filter("labels", lambda x: x != F.col("label")), F.lit(1)), F.col("label"))
    return rows.crossJoin(F.broadcast(labels)).select("doc_id", "label", F.when(F.col("doc_id") % 5 == 0, other).otherwise(F.col("label")).alias("predicted"))


def entity_rows(spark: SparkSession, d: str) -> DataFrame:
    names = F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))
    span = F.transform(names, lambda x: F.struct(x.alias("text"), F.when(F.length(x) % 2 == 0, "ORG").otherwise("PER").alias("type")))
    return table(spark, d, "documents").select("doc_id", "text", F.coalesce(span, F.array().cast(T.SPAN)).alias("entities"))


_ENT = "e AS (SELECT doc_id, text, list_transform(coalesce(regexp_extract_all(text, '[A-Z][a-z]+'), []), lambda x: {'text': x, 'type': CASE WHEN length(x) % 2 = 0 THEN 'ORG' ELSE 'PER' END}) AS entities FROM documents)"


# ---- controls -------------------------------------------------------------------------

_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> ''))"
_NEAR_PAIRS = f"w AS (SELECT doc_id, {_WORDS} AS w FROM documents), p AS (SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.w, b.w)) AS o, len(a.w) AS x, len(b.w) AS y FROM w a JOIN w b ON a.doc_id < b.doc_id AND least(len(a.w), len(b.w)) >= 0.9 * greatest(len(a.w), len(b.w))), np AS (SELECT a, b FROM p WHERE o / (x + y - o) >= 0.9)"


def _band(source: str) -> str:
    """CTEs `banded`: the rows of `source` that the band rule keeps; one recursion step a row, the last 50 word sets as its state."""
    dup = "len(list_filter(recent, lambda r: len(list_intersect(r, w)) / (len(r) + len(w) - len(list_intersect(r, w))) >= 0.9)) > 0"
    return f"""bw AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w, row_number() OVER (ORDER BY doc_id) AS k FROM {source}),
bf AS (SELECT 0::BIGINT AS k, NULL::BIGINT AS doc_id, []::VARCHAR[][] AS recent, true AS dup
  UNION ALL SELECT k, doc_id, CASE WHEN dup OR len(w) = 0 THEN recent ELSE list_append(list_slice(recent, greatest(len(recent) - 48, 1), len(recent)), w) END, dup FROM (SELECT bw.k, bw.doc_id, bw.w, recent, len(w) > 0 AND {dup} AS dup FROM bf JOIN bw ON bw.k = bf.k + 1)),
banded AS (SELECT doc_id FROM bf WHERE NOT dup)"""


def _diverse(source: str) -> str:
    """CTEs `diverse`: the rows of `source` (doc_id, text, entities) that entity caps keep; one recursion step a contested row."""
    return f"""dm AS (SELECT doc_id, lower(m.text) AS v FROM (SELECT doc_id, unnest(entities) AS m FROM {source})), dc AS (SELECT v FROM dm GROUP BY v HAVING count(*) > 3),
dr AS MATERIALIZED (SELECT doc_id, list(v) AS vs, row_number() OVER (ORDER BY doc_id) AS k FROM dm SEMI JOIN dc USING (v) GROUP BY doc_id),
df AS (SELECT 0::BIGINT AS k, NULL::BIGINT AS doc_id, []::VARCHAR[] AS used, false AS lost
  UNION ALL SELECT k, doc_id, CASE WHEN lost THEN used ELSE list_concat(used, vs) END, lost FROM (SELECT dr.k, dr.doc_id, dr.vs, used, len(list_filter(vs, lambda v: len(list_filter(used, lambda u: u = v)) >= 3)) > 0 AS lost FROM df JOIN dr ON dr.k = df.k + 1)),
diverse AS (SELECT * FROM {source} WHERE doc_id NOT IN (SELECT doc_id FROM df WHERE lost))"""


def _fitting(source: str, name: str) -> str:
    """CTE `name`: rows of `source` of at most three times the upper median length."""
    return f"{name} AS (SELECT * FROM {source} WHERE length(text) <= 3 * (SELECT greatest(n, 1) FROM (SELECT length(text) AS n, row_number() OVER (ORDER BY length(text)) AS rn, count(*) OVER () AS m FROM {source}) WHERE rn = m // 2 + 1))"


_CAPPED = "c AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS rn FROM b) WHERE rn <= 3 * (SELECT min(n) FROM (SELECT count(*) AS n FROM b GROUP BY label)))"
_FITTING = "k AS (SELECT * FROM c WHERE length(text) <= 3 * (SELECT greatest(n, CASE WHEN n = 0 THEN 1 ELSE n END) FROM (SELECT length(text) AS n, row_number() OVER (ORDER BY length(text)) AS rn, count(*) OVER () AS m FROM c) WHERE rn = m // 2 + 1))"


@_query(f"WITH {_BINARY}, {_CAPPED}, {_FITTING} SELECT label, count(*) AS n, sum(length(text))::BIGINT AS chars FROM k GROUP BY label")
def label_counts(spark, d):
    kept = controls.drop_length_outliers(controls.label_cap(binary_rows(spark, d), "doc_id"))
    return kept.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("chars"))


@_query(f"WITH {_BINARY}, {_CAPPED} SELECT doc_id, label FROM c")
def label_balance_cap(spark, d):
    return controls.label_cap(binary_rows(spark, d), "doc_id").select("doc_id", "label")


@_query("SELECT doc_id, length(text)::BIGINT AS chars FROM documents WHERE length(text) <= 3 * (SELECT n FROM (SELECT length(text) AS n, row_number() OVER (ORDER BY length(text)) AS rn, count(*) OVER () AS m FROM documents) WHERE rn = m // 2 + 1)")
def length_outlier_filter(spark, d):
    return controls.drop_length_outliers(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.length("text").cast("bigint").alias("chars"))


@_query(f"WITH {_NEAR_PAIRS} SELECT a, b FROM np")
def jaccard_pairs(spark, d):
    return controls.near_pairs(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


@_query(f"""WITH RECURSIVE {_NEAR_PAIRS}, o AS MATERIALIZED (SELECT b AS id, list(a) AS before, row_number() OVER (ORDER BY b) AS k FROM np GROUP BY b),
f AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS lost UNION ALL SELECT o.k, CASE WHEN len(list_filter(before, lambda x: NOT list_contains(lost, x))) > 0 THEN list_append(lost, o.id) ELSE lost END FROM f JOIN o ON o.k = f.k + 1)
SELECT doc_id FROM documents WHERE NOT list_contains((SELECT lost FROM f ORDER BY k DESC LIMIT 1), doc_id)""")
def surface_dedup_global(spark, d):
    return controls.surface_dedup(table(spark, d, "documents").select("doc_id", "text"), "doc_id", mode="global").select("doc_id")


@_query(f"WITH RECURSIVE {_band('documents')} SELECT doc_id FROM banded")
def surface_dedup_band50(spark, d):
    return controls.surface_dedup(table(spark, d, "documents").select("doc_id", "text"), "doc_id", mode="band").select("doc_id")


@_query(f"WITH {_ENT} SELECT lower(m.text) AS value, count(*) AS n FROM (SELECT unnest(entities) AS m FROM e) GROUP BY 1")
def entity_counts(spark, d):
    return entity_rows(spark, d).select(F.explode("entities").alias("m")).groupBy(F.lower("m.text").alias("value")).agg(F.count("*").alias("n"))


@_query(f"WITH {_ENT} SELECT lower(m.text) AS value, count(*) AS n FROM (SELECT unnest(entities) AS m FROM e) GROUP BY 1 HAVING count(*) > 3")
def entity_over_represented(spark, d):
    return entity_counts(spark, d).where("n > 3")


@_query(f"WITH RECURSIVE {_ENT}, {_diverse('e')} SELECT doc_id FROM diverse")
def entity_diversification(spark, d):
    return controls.diversify_entities(entity_rows(spark, d), "doc_id").select("doc_id")


@_query(f"WITH {_LANG}, t AS (SELECT DISTINCT text FROM l WHERE doc_id % 7 = 0) SELECT doc_id, label FROM l WHERE text NOT IN (SELECT text FROM t)")
def eval_exclusion_anti_join(spark, d):
    rows = language_rows(spark, d)
    return controls.without_texts(rows, rows.where("doc_id % 7 = 0")).select("doc_id", "label")


_QUOTA = f"""{_LANG}, q AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM l),
f AS (SELECT doc_id, text, label FROM q WHERE rn <= 150 // (SELECT count(DISTINCT label) FROM l)),
r AS (SELECT doc_id, text, label FROM l WHERE text NOT IN (SELECT text FROM f) ORDER BY md5('42:' || doc_id), doc_id LIMIT 150)
SELECT doc_id, label FROM f UNION ALL (SELECT doc_id, label FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k FROM r) WHERE k <= 150 - (SELECT count(*) FROM f))"""


@_query(f"WITH {_QUOTA}")
def per_label_quota_fill(spark, d):
    return controls.select_budget(language_rows(spark, d), "doc_id", 150).select("doc_id", "label")


_SEEDED = "md5('42:' || doc_id), doc_id"


@_query(lambda: f"""WITH RECURSIVE {_ROUND}, tr AS (SELECT * FROM l WHERE text NOT IN (SELECT text FROM ev)),
cq AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_SEEDED}) AS rn FROM tr) WHERE rn <= 150 // (SELECT count(DISTINCT label) FROM tr)),
cr AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (ORDER BY {_SEEDED}) AS k FROM tr WHERE text NOT IN (SELECT text FROM cq)) WHERE k <= 150 - (SELECT count(*) FROM cq)),
cs AS (SELECT * FROM cq UNION ALL SELECT * FROM cr), cc AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS rn FROM cs) WHERE rn <= 3 * (SELECT min(n) FROM (SELECT count(*) AS n FROM cs GROUP BY label))),
{_fitting('cc', 'cf')}, {_band('cf')} SELECT doc_id, label FROM cf SEMI JOIN banded USING (doc_id)""")
def curriculum_classification(spark, d):
    rows = language_rows(spark, d)
    held = evalset.build(rows, "classification", "doc_id")
    return controls.curriculum(rows, held, "doc_id").select("doc_id", "label")


@_query(f"""WITH RECURSIVE {_ENT}, tr AS (SELECT * FROM e WHERE text NOT IN (SELECT text FROM e WHERE doc_id % 10 = 0)), cs AS (SELECT * FROM tr ORDER BY {_SEEDED} LIMIT 300), {_diverse('cs')}, {_fitting('diverse', 'cf')} SELECT doc_id FROM cf""")
def curriculum_ner(spark, d):
    rows = entity_rows(spark, d)
    return controls.curriculum(rows, rows.where("doc_id % 10 = 0"), "doc_id", "NER", 300).select("doc_id")


_GEN = "g AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN text END AS prompt, CASE WHEN doc_id % 3 > 0 THEN lang END AS response, CASE WHEN doc_id % 3 = 0 THEN text END AS text, CASE WHEN doc_id % 3 = 0 THEN lang END AS label FROM documents)"


@_query(f"WITH {_GEN}, n AS (SELECT doc_id, length(coalesce(prompt, text)) AS n FROM g) SELECT doc_id FROM n WHERE n <= 3 * (SELECT n FROM (SELECT n, row_number() OVER (ORDER BY n) AS rn, count(*) OVER () AS m FROM n) WHERE rn = m // 2 + 1)")
def generation_controls(spark, d):
    r = F.col("doc_id") % 3
    rows = table(spark, d, "documents").select("doc_id", F.when(r > 0, F.col("text")).alias("prompt"), F.when(r > 0, F.col("lang")).alias("response"), F.when(r == 0, F.col("text")).alias("text"), F.when(r == 0, F.col("lang")).alias("label"))
    return controls.quality_controls(rows, "generation", "doc_id").select("doc_id")


@_query(f"""WITH {_BINARY}, r AS (SELECT doc_id, text, label FROM b ORDER BY doc_id LIMIT 60)
SELECT doc_id, origin, CASE WHEN origin = 'gold' THEN label ELSE coalesce((SELECT min(x.label) FROM b x WHERE x.label <> r.label), label) END AS label,
  CASE WHEN origin = 'gold' THEN md5(text) ELSE md5(coalesce((SELECT min(x.label) FROM b x WHERE x.label <> r.label), label) || ': ' || text) END AS text_md5 FROM r, (VALUES ('gold'), ('synthetic')) o(origin)""")
def hard_negative_stub(spark, d):
    made = controls.hard_negatives(binary_rows(spark, d), "doc_id", 60, lambda text, label, target: f"{target}: {text}")
    return made.select("doc_id", "origin", "label", F.md5("text").alias("text_md5"))


@_query("WITH r AS (SELECT source, CASE WHEN doc_id % 20 < 13 THEN 'gold' WHEN doc_id % 2 = 0 THEN 'hard_orig' ELSE 'hard_syn' END AS origin FROM documents), c AS (SELECT count(*) FILTER (origin = 'gold') AS n_gold, count(*) FILTER (origin <> 'gold') AS n_hard FROM r) SELECT n_gold, n_hard, round_even(n_gold * 100 / greatest(n_gold + n_hard, 1), 0) AS gold_percent, round_even(n_hard * 100 / greatest(n_gold + n_hard, 1), 0) AS hard_percent FROM c")
def composition_ratio(spark, d):
    origin = F.when(F.col("doc_id") % 20 < 13, "gold").when(F.col("doc_id") % 2 == 0, "hard_orig").otherwise("hard_syn")
    return controls.composition(table(spark, d, "documents").select(origin.alias("origin")))


# ---- evaluation sets ------------------------------------------------------------------


@_query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor((SELECT count(*) FROM documents) * 0.8) THEN 'train' ELSE 'test' END AS part FROM documents")
def seeded_split(spark, d):
    return evalset.split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.2)


@_query(f"WITH {_BINARY}, n AS (SELECT label, count(*) AS n, min(doc_id) AS seen FROM b GROUP BY label), p AS (SELECT label AS pos_label FROM n ORDER BY n.n, seen LIMIT 1) SELECT pos_label, coalesce((SELECT min(label) FROM n WHERE label <> pos_label), pos_label) AS neg_label FROM p")
def minority_label(spark, d):
    return evalset.minority_label(binary_rows(spark, d), "doc_id")


_SIDES = "n AS (SELECT label, count(*) AS n, min(doc_id) AS seen FROM b GROUP BY label), pl AS (SELECT label AS pos_label FROM n ORDER BY n.n, seen LIMIT 1), nl AS (SELECT min(label) AS neg_label FROM n WHERE label <> (SELECT pos_label FROM pl)), p AS (SELECT b.* FROM b, pl WHERE label = pos_label), g AS (SELECT b.* FROM b, nl WHERE label = neg_label), m AS (SELECT avg(length(text)) AS m FROM p)"
_NEAR = "near AS (SELECT g.* FROM g, m ORDER BY abs(length(text) - m), doc_id LIMIT 40)"


@_query(f"WITH {_BINARY}, {_SIDES}, {_NEAR} SELECT doc_id, label FROM near")
def boundary_top_k(spark, d):
    rows = binary_rows(spark, d)
    told = evalset.minority_label(rows, "doc_id").first()
    mean = rows.where(F.col("label") == told.pos_label).agg(F.avg(F.length("text"))).first()[0]
    return rows.where(F.col("label") == told.neg_label).orderBy(F.abs(F.length("text") - mean), "doc_id").limit(40).select("doc_id", "label")


@_query(f"""WITH {_BINARY}, {_SIDES}, {_NEAR}, s AS (SELECT p.* FROM p, m WHERE length(text) < 0.6 * m),
bd AS (SELECT * FROM (SELECT * FROM near UNION ALL SELECT * FROM s) ORDER BY md5('42:' || doc_id), doc_id LIMIT 20),
ng AS (SELECT * FROM g WHERE text NOT IN (SELECT text FROM bd) ORDER BY md5('42:' || doc_id), doc_id LIMIT 40),
ps AS (SELECT * FROM p WHERE text NOT IN (SELECT text FROM bd) ORDER BY md5('42:' || doc_id), doc_id LIMIT 40)
SELECT doc_id, label, 'boundary' AS slice FROM bd UNION ALL SELECT doc_id, label, 'neg' FROM ng UNION ALL SELECT doc_id, label, 'pos' FROM ps""")
def binary_eval_set(spark, d):
    return evalset.build(binary_rows(spark, d), "classification", "doc_id").select("doc_id", "label", "slice")


_TURNS = "f AS (SELECT label, row_number() OVER (ORDER BY min(doc_id)) AS turn FROM l GROUP BY label)"


def _draw(pool: str, n: int) -> str:
    return f"(SELECT doc_id, label FROM (SELECT {pool}.*, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM {pool}) JOIN f USING (label) ORDER BY rn, turn LIMIT {n})"


@_query(f"""WITH {_LANG}, {_TURNS}, p AS {_draw('l', 40)}, l2 AS (SELECT * FROM l ANTI JOIN p USING (doc_id)), bd AS {_draw('l2', 20)}, l3 AS (SELECT * FROM l2 ANTI JOIN bd USING (doc_id)), g AS {_draw('l3', 40)}
SELECT doc_id, label, 'pos' AS slice FROM p UNION ALL SELECT doc_id, label, 'boundary' FROM bd UNION ALL SELECT doc_id, label, 'neg' FROM g""")
def round_robin_multiclass(spark, d):
    return evalset.build(language_rows(spark, d), "classification", "doc_id").select("doc_id", "label", "slice")


@_query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k FROM documents) SELECT doc_id, CASE WHEN k <= 40 THEN 'pos' WHEN k <= 80 THEN 'neg' ELSE 'boundary' END AS slice FROM r WHERE k <= 100")
def thirds_eval_set(spark, d):
    return evalset.build(table(spark, d, "documents").select("doc_id"), "generation", "doc_id")


_ROUND = f"""{_LANG}, {_TURNS}, p0 AS {_draw('l', 40)}, l2 AS (SELECT * FROM l ANTI JOIN p0 USING (doc_id)), bd AS {_draw('l2', 20)}, l3 AS (SELECT * FROM l2 ANTI JOIN bd USING (doc_id)), g0 AS {_draw('l3', 40)},
ev AS (SELECT l.*, slice FROM l JOIN (SELECT doc_id, 'pos' AS slice FROM p0 UNION ALL SELECT doc_id, 'boundary' FROM bd UNION ALL SELECT doc_id, 'neg' FROM g0) USING (doc_id))"""


@_query(f"WITH {_ROUND} SELECT slice, doc_id, label, md5(text) AS text_md5, 'classification' AS task_type, (SELECT count(*) FROM ev) AS total FROM ev")
def eval_set_json(spark, d):
    told = evaluation_json(evalset.build(language_rows(spark, d), "classification", "doc_id"), "classification", "doc_id")
    item = "array<struct<doc_id:bigint,text:string,label:string>>"
    read = told.select(F.from_json("json", f"task_type string, counts struct<total:bigint>, pos {item}, neg {item}, boundary {item}").alias("j"))
    named = lambda s: F.transform(f"j.{s}", lambda x: F.struct(F.lit(s).alias("slice"), x.doc_id.alias("doc_id"), x.label.alias("label"), F.md5(x.text).alias("text_md5")))
    parts = F.flatten(F.array(*[named(s) for s in ("pos", "neg", "boundary")]))
    return read.select(F.explode(parts).alias("x"), F.col("j.task_type").alias("task_type"), F.col("j.counts.total").alias("total")).select("x.*", "task_type", "total")


# ---- scores ---------------------------------------------------------------------------


@_query(f"WITH {_BINARY}, {_GUESS_SQL.format('b')}, c AS (SELECT count(*) FILTER (label = '0' AND predicted = '0') AS tp, count(*) FILTER (label <> '0' AND predicted = '0') AS fp, count(*) FILTER (label = '0' AND predicted <> '0') AS fn FROM p) SELECT tp, fp, fn, CASE WHEN tp = 0 THEN 0.0 ELSE 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) END AS f1 FROM c")
def binary_f1(spark, d):
    return metrics.binary_f1(guessed(binary_rows(spark, d)), "0")


_PER_CLASS = "c AS (SELECT label, (SELECT count(*) FROM p WHERE p.label = x.label) AS support, (SELECT count(*) FROM p WHERE p.label = x.label AND predicted = x.label) AS tp, (SELECT count(*) FROM p WHERE p.label <> x.label AND predicted = x.label) AS fp FROM (SELECT DISTINCT label FROM p) x), s AS (SELECT label, support, tp, fp, support - tp AS fn, CASE WHEN tp = 0 THEN 0.0 ELSE 2 * (tp / (tp + fp)) * (tp / support) / (tp / (tp + fp) + tp / support) END AS f1 FROM c)"


@_query(f"WITH {_LANG}, {_GUESS_SQL.format('l')}, {_PER_CLASS} SELECT label, support::BIGINT AS support, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, round(f1, 9) AS f1 FROM s")
def per_class_f1(spark, d):
    got = metrics.per_class_f1(guessed(language_rows(spark, d)))
    return got.select("label", *[F.col(c).cast("bigint").alias(c) for c in ("support", "tp", "fp", "fn")], F.round("f1", 9).alias("f1"))


@_query(f"WITH {_LANG}, {_GUESS_SQL.format('l')}, {_PER_CLASS} SELECT round(avg(f1), 9) AS f1, count(*) AS classes FROM s")
def macro_f1(spark, d):
    return metrics.headline_f1(guessed(language_rows(spark, d))).select(F.round("f1", 9).alias("f1"), "classes")


_PRED_ENT = "q AS (SELECT doc_id, list_distinct(entities) AS g, list_distinct(list_filter(list_transform(entities, lambda s: CASE WHEN length(s['text']) % 3 = 0 THEN {'text': s['text'], 'type': 'LOC'} ELSE s END), lambda s: length(s['text']) % 7 > 0)) AS p FROM e)"


def guessed_entities(rows: DataFrame) -> DataFrame:
    changed = F.transform("entities", lambda s: F.when(F.length(s.text) % 3 == 0, F.struct(s.text.alias("text"), F.lit("LOC").alias("type"))).otherwise(s))
    return rows.withColumn("predicted", F.filter(changed, lambda s: F.length(s.text) % 7 > 0))


@_query(f"WITH {_ENT}, {_PRED_ENT}, c AS (SELECT sum(len(list_intersect(g, p)))::BIGINT AS tp, sum(len(p))::BIGINT AS np, sum(len(g))::BIGINT AS ng FROM q) SELECT tp, np - tp AS fp, ng - tp AS fn, CASE WHEN tp = 0 THEN 0.0 ELSE round(2 * (tp / np) * (tp / ng) / (tp / np + tp / ng), 9) END AS f1 FROM c")
def entity_f1_micro(spark, d):
    return metrics.entity_f1(guessed_entities(entity_rows(spark, d))).withColumn("f1", F.round("f1", 9))


_SLICED = "CASE doc_id % 4 WHEN 0 THEN 'pos' WHEN 1 THEN 'neg' ELSE 'boundary' END"


def _slice():
    r = F.col("doc_id") % 4
    return F.when(r == 0, "pos").when(r == 1, "neg").otherwise("boundary")


@_query(f"WITH {_LANG}, {_GUESS_SQL.format('l')} SELECT {_SLICED} AS slice, count(*) AS n, round(avg((label = predicted)::INT), 9) AS accuracy FROM p GROUP BY 1")
def slice_accuracy(spark, d):
    rows = guessed(language_rows(spark, d)).withColumn("slice", _slice())
    return metrics.slice_accuracy(rows, F.col("label") == F.col("predicted")).withColumn("accuracy", F.round("accuracy", 9))


@_query(f"WITH {_ENT}, {_PRED_ENT} SELECT {_SLICED} AS slice, count(*) AS n, round(avg(((len(g) > 0) = (len(p) > 0))::INT), 9) AS accuracy FROM q GROUP BY 1")
def has_entity_slice(spark, d):
    rows = guessed_entities(entity_rows(spark, d)).withColumn("slice", _slice())
    return metrics.slice_accuracy(rows, (F.size("entities") > 0) == (F.size("predicted") > 0)).withColumn("accuracy", F.round("accuracy", 9))


_REPLY_SQL = "r AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '1.0' WHEN 1 THEN ' 0.5 ' WHEN 2 THEN 'n/a' WHEN 3 THEN '' ELSE '0.25' END AS reply FROM documents), v AS (SELECT doc_id, coalesce(try_cast(trim(reply) AS DOUBLE), 0.0) AS s FROM r)"


def _replies(spark, d):
    r = F.col("doc_id") % 5
    reply = F.when(r == 0, "1.0").when(r == 1, " 0.5 ").when(r == 2, "n/a").when(r == 3, "").otherwise("0.25")
    return table(spark, d, "documents").select("doc_id", metrics.judge_scores(reply).alias("s"))


@_query(f"WITH {_REPLY_SQL} SELECT count(*) AS n, round(avg(s), 9) AS mean, count(*) FILTER (s >= 0.5) AS passed FROM v")
def judge_score_mean(spark, d):
    return _replies(spark, d).agg(F.count("*").alias("n"), F.round(F.avg("s"), 9).alias("mean"), F.count_if(F.col("s") >= 0.5).alias("passed"))


@_query("WITH r AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ' The Label is ' || upper(lang) || '. ' WHEN 1 THEN 'champion ' || lang WHEN 2 THEN '???' ELSE lang END AS raw FROM documents), g AS (SELECT list_sort(list(DISTINCT lang)) AS ls FROM documents) SELECT doc_id, coalesce(list_filter(ls, lambda x: contains(lower(trim(raw)), lower(x)))[1], '__EXTRACTION_FAILED__') AS predicted FROM r, g")
def label_extraction(spark, d):
    docs, r = table(spark, d, "documents"), F.col("doc_id") % 4
    raw = F.when(r == 0, F.concat(F.lit(" The Label is "), F.upper("lang"), F.lit(". "))).when(r == 1, F.concat(F.lit("champion "), F.col("lang"))).when(r == 2, "???").otherwise(F.col("lang"))
    labels = docs.agg(F.collect_set("lang").alias("ls"))
    return docs.crossJoin(F.broadcast(labels)).select("doc_id", T.extract_label(raw, F.col("ls")).alias("predicted"))


@_query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS n, CASE WHEN doc_id % 3 = 0 THEN lang END AS first_text FROM documents")
def ner_json_extraction(spark, d):
    r = F.col("doc_id") % 3
    good = F.concat(F.lit('Sure: [{"text": "'), F.col("lang"), F.lit('", "type": "LANG"}, {"text": "x"}] done]'))
    raw = F.when(r == 0, good).when(r == 1, "no list here").otherwise('[{"text": broken]')
    spans = T.spans_of(raw)
    return table(spark, d, "documents").select("doc_id", F.size(spans).cast("bigint").alias("n"), F.try_element_at(spans, F.lit(1)).text.alias("first_text"))


@_query(f"WITH {_LANG}, {_GUESS_SQL.format('l')}, f AS (SELECT * FROM p WHERE label <> predicted ORDER BY doc_id LIMIT 50) SELECT label || '→' || predicted AS pattern, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, min(doc_id) LIMIT 10")
def failure_taxonomy_topk(spark, d):
    return metrics.failure_taxonomy(metrics.failures(guessed(language_rows(spark, d))), "doc_id").select("pattern", "n")


@_query(f"WITH {_BINARY}, r AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS k, count(*) OVER () AS m FROM b) SELECT doc_id, CASE WHEN k <= round_even(0.85 * m, 0) THEN label ELSE coalesce((SELECT min(label) FROM b x WHERE x.label <> r.label), label) END AS predicted FROM r")
def scripted_predictions(spark, d):
    return metrics.scripted_predictions(binary_rows(spark, d), F.lit(0.85), "doc_id").select("doc_id", "predicted")


# ---- pages and formats ----------------------------------------------------------------


_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_RAW = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?is)<title[^>]*>.*?</title>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
_PAGES = f"hits AS (SELECT page_id, url, nullif(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title, left({_STRIP.format(f"regexp_replace({_RAW}, '[ \\t]+', ' ', 'g')")}, 800) AS text FROM pages)"


@_query(f"WITH {_PAGES}, t AS (SELECT page_id, url, title, replace({_STRIP.format('text')}, chr(10), ' ') AS t FROM hits) SELECT page_id, left({_STRIP.format("coalesce(title, '')")} || '. ' || t, 700) AS text FROM t WHERE length(t) >= 180 AND NOT contains(url, '/archive/') AND NOT contains(url, '/list/') AND NOT contains(url, '/find/')")
def web_documents(spark, d):
    return documents_of(hits(table(spark, d, "pages"))).select("page_id", "text")


@_query("WITH h AS (SELECT doc_id, 'https://x.org' || CASE doc_id % 6 WHEN 0 THEN '/list/' WHEN 1 THEN '/archive/' ELSE '/p/' END || doc_id AS url, CASE WHEN doc_id % 4 > 0 THEN ' ' || source || ' ' END AS title, replace(trim(text, ' ' || chr(10) || chr(9) || chr(13)), chr(10), ' ') AS t FROM documents) SELECT doc_id, left(trim(coalesce(title, '')) || '. ' || t, 700) AS text FROM h WHERE length(t) >= 180 AND NOT contains(url, '/archive/') AND NOT contains(url, '/list/') AND NOT contains(url, '/find/')")
def web_doc_filter(spark, d):
    r = F.col("doc_id") % 6
    url = F.concat(F.lit("https://x.org"), F.when(r == 0, "/list/").when(r == 1, "/archive/").otherwise("/p/"), F.col("doc_id").cast("string"))
    rows = table(spark, d, "documents").select("doc_id", url.alias("url"), F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit(" "), F.col("source"), F.lit(" "))).alias("title"), "text")
    return documents_of(rows).select("doc_id", "text")


@_query("WITH s AS (SELECT DISTINCT source AS label FROM documents) SELECT label, CASE WHEN label IN ('src1', 'src2') THEN 'about ' || label ELSE label || ' example text' END AS query FROM s")
def label_queries(spark, d):
    labels = table(spark, d, "documents").select(F.col("source").alias("label")).distinct()
    return with_query(labels, spark.createDataFrame([("src1", "about src1"), ("src2", "about src2")], "label string, query string"))


@_query(f"WITH {_PAGES}, h AS (SELECT *, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM hits) SELECT host, string_agg('**' || coalesce(title, '') || '**' || chr(10) || url || chr(10) || left(text, 500), chr(10) || '---' || chr(10) ORDER BY page_id) AS report FROM h GROUP BY host UNION ALL SELECT 'nowhere.org', 'No results found.'")
def search_reports(spark, d):
    found = hits(table(spark, d, "pages")).withColumn("host", F.regexp_extract("url", r"^https?://([^/]+)", 1))
    return search_report(found, "page_id", "host", found.select("host").union(spark.range(1).select(F.lit("nowhere.org"))))


@_query("WITH f AS (SELECT doc_id, lang, rtrim(replace(text, chr(10), ' '), ' ' || chr(9) || chr(13)) AS t FROM documents) SELECT doc_id, lang AS label, t AS text FROM f WHERE t <> ''")
def tsv_parse(spark, d):
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.lit(" "), F.col("lang"), F.lit("\t"), flat, F.lit(" \r")).alias("value"))
    parts = tsv_rows(rows.select("doc_id", "value").withColumn("value", F.concat(F.col("doc_id").cast("string"), F.lit("\u0001"), F.col("value"))))
    return parts.select(F.split("label", "\u0001")[0].cast("bigint").alias("doc_id"), T.strip(F.split("label", "\u0001")[1]).alias("label"), "text")


@_query("SELECT doc_id, md5('Classify this message. Reply with exactly one word — the label.' || chr(10) || chr(10) || 'Message: ' || text || chr(10) || chr(10) || 'Answer: ' || lang) AS plain_md5 FROM documents")
def example_format(spark, d):
    _, _, plain = T.training_text("classification", F.col("text"), F.col("lang"))
    return table(spark, d, "documents").select("doc_id", F.md5(plain).alias("plain_md5"))


@_query("SELECT doc_id, (length(text) // 4)::BIGINT AS tokens, length(text) // 4 > 8000 AS too_long FROM documents")
def token_estimate(spark, d):
    t = T.token_estimate(F.col("text"))
    return table(spark, d, "documents").select("doc_id", t.alias("tokens"), (t > 8000).alias("too_long"))


@_query("SELECT p_partkey, CASE WHEN contains(s, 'spam') OR contains(s, 'classify') OR contains(s, 'sentiment') THEN 'classification' WHEN contains(s, 'ner') OR contains(s, 'tagging') THEN 'NER' WHEN contains(s, 'arc') OR contains(s, 'math') THEN 'generation' END AS task FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'spam of ' WHEN 1 THEN 'text generation ' WHEN 2 THEN 'a research paper ' WHEN 3 THEN 'tagging ' WHEN 4 THEN 'math ' ELSE 'other ' END || p_size AS s FROM part)")
def task_type_case(spark, d):
    r = F.col("p_partkey") % 6
    said = F.when(r == 0, "spam of ").when(r == 1, "text generation ").when(r == 2, "a research paper ").when(r == 3, "tagging ").when(r == 4, "math ").otherwise("other ")
    return table(spark, d, "part").select("p_partkey", T.task_type(F.concat(said, F.col("p_size").cast("string"))).alias("task"))


# ---- lineage and decisions: one run a user, an event's value as a score -----------------

_SCORES = "s AS (SELECT user_id AS run, event_id AS seq, round(value / (1 + abs(value)), 6) AS score, event_id % 7 = 0 AS pruned FROM events)"


def scores(spark, d):
    v = F.round(F.col("value") / (1 + F.abs("value")), 6)
    return table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), v.alias("score"), (F.col("event_id") % 7 == 0).alias("pruned"), F.col("event_id").alias("iteration"))


@_query(f"WITH {_SCORES} SELECT seq, score, CASE WHEN score < 0.80 THEN 'data_rebuild' WHEN score < 0.95 THEN 'hyperparameter' ELSE 'surgical' END AS intervention FROM s")
def iteration_policy(spark, d):
    return scores(spark, d).select("seq", "score", lineage.policy(F.col("score")).alias("intervention"))


_BEST = f"{_SCORES}, x AS (SELECT *, max(score) OVER (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM s), y AS (SELECT *, best_before IS NULL OR score > best_before AS improved FROM x), z AS (SELECT *, sum(improved::INT) OVER (PARTITION BY run ORDER BY seq) AS island FROM y), n AS (SELECT *, row_number() OVER (PARTITION BY run, island ORDER BY seq) - 1 AS no_improve FROM z)"


@_query(f"WITH {_BEST} SELECT run, seq, best_before, improved FROM n")
def best_so_far(spark, d):
    return lineage.best_so_far(scores(spark, d)).select("run", "seq", "best_before", "improved")


@_query(f"WITH {_BEST} SELECT seq, no_improve, CASE WHEN score >= 0.99 THEN 'terminate' WHEN no_improve >= 2 THEN 'escalate' WHEN score >= 0.80 AND score < 0.95 THEN 'train' ELSE 'curate' END AS next_action FROM n")
def no_improvement_counter(spark, d):
    got = lineage.best_so_far(scores(spark, d)).withColumn("no_improve", F.col("no_improve").cast("bigint"))
    return got.select("seq", "no_improve", lineage.next_action(F.col("score"), F.lit(0.99), F.col("no_improve"), lineage.policy(F.col("score"))).alias("next_action"))


@_query(f"WITH {_BEST} SELECT run, count(*) FILTER (score > coalesce(greatest(best_before, -1), -1) + 1e-9) AS improvements FROM n GROUP BY run")
def improvement_count(spark, d):
    return lineage.improvements(scores(spark, d)).select("run", F.col("improvements").cast("bigint").alias("improvements"))


@_query(f"""WITH RECURSIVE {_SCORES}, o AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY seq) AS k FROM s),
f AS (SELECT run, k, score AS last, score AS best, 0 AS rollbacks, 0 AS no_improve, 1 AS accepted FROM o WHERE k = 1
  UNION ALL SELECT o.run, o.k, CASE WHEN o.score < f.last THEN f.last ELSE o.score END, greatest(f.best, o.score), f.rollbacks + (o.score < f.last)::INT,
    CASE WHEN o.score > f.best THEN 0 ELSE f.no_improve + 1 + (o.score < f.last)::INT END, f.accepted + (o.score >= f.last)::INT FROM f JOIN o ON o.run = f.run AND o.k = f.k + 1)
SELECT run, rollbacks::BIGINT AS rollbacks, best, no_improve::BIGINT AS no_improve, accepted::BIGINT AS accepted FROM f QUALIFY row_number() OVER (PARTITION BY run ORDER BY k DESC) = 1""")
def rollback_fold(spark, d):
    got = lineage.rollback_fold(scores(spark, d))
    return got.select("run", F.col("rollbacks").cast("bigint").alias("rollbacks"), "best", F.col("no_improve").cast("bigint").alias("no_improve"), F.size("accepted").cast("bigint").alias("accepted"))


@_query(f"WITH {_SCORES} SELECT seq, lag(seq) OVER w AS parent_iteration, lag(score) OVER w AS parent_score FROM s WINDOW w AS (PARTITION BY run ORDER BY seq)")
def dag_parent_join(spark, d):
    return lineage.with_parent(scores(spark, d)).select("seq", "parent_iteration", "parent_score")


@_query(f"WITH {_SCORES} SELECT run, seq AS iteration, score FROM s WHERE NOT pruned QUALIFY row_number() OVER (PARTITION BY run ORDER BY score DESC, seq) = 1")
def best_non_pruned(spark, d):
    return lineage.best_node(scores(spark, d))


_TREE = "t AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey > 1 THEN o_orderkey // 4 END AS parent_id, o_totalprice AS score FROM orders), u AS (SELECT id, CASE WHEN parent_id IN (SELECT id FROM t) THEN parent_id END AS parent_id, score FROM t)"


def tree(spark, d):
    """Orders as a tree: the parent of k is k // 4, if there is such an order."""
    t = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") > 1, F.floor(F.col("o_orderkey") / 4)).alias("p"), F.col("o_totalprice").alias("score"))
    known = t.select(F.col("id").alias("parent_id"))
    return t.join(known, t.p == known.parent_id, "left").select("id", "parent_id", "score")


_BACKED = f"{_TREE}, r AS (SELECT id AS node, id AS anc, score, parent_id AS up FROM u UNION ALL SELECT r.node, u.id, r.score, u.parent_id FROM r JOIN u ON u.id = r.up), v AS (SELECT anc AS id, count(*) AS visits, avg(score) AS mean_score FROM r GROUP BY anc)"


@_query(f"WITH RECURSIVE {_BACKED} SELECT id, visits, round(mean_score, 4) AS mean_score FROM v")
def ancestor_backprop(spark, d):
    return lineage.backpropagate(tree(spark, d)).withColumn("mean_score", F.round("mean_score", 4))


@_query("WITH c AS (SELECT user_id AS parent_id, hash_id AS id, count(*) AS visits, avg(value) AS mean_score FROM (SELECT *, event_id % 8 AS hash_id FROM events) GROUP BY ALL), x AS (SELECT *, mean_score + 1.4142135623730951 * sqrt(ln(sum(visits) OVER (PARTITION BY parent_id)) / visits) AS uct FROM c) SELECT parent_id, id, round(uct, 6) AS uct FROM x QUALIFY row_number() OVER (PARTITION BY parent_id ORDER BY x.uct DESC, id) = 1")
def uct_select(spark, d):
    c = table(spark, d, "events").groupBy(F.col("user_id").alias("parent_id"), (F.col("event_id") % 8).alias("id")).agg(F.count("*").alias("visits"), F.avg("value").alias("mean_score"))
    return lineage.uct(c).where("chosen").select("parent_id", "id", F.round("uct", 6).alias("uct"))


@_query(f"WITH {_SCORES} SELECT seq, CASE WHEN row_number() OVER (PARTITION BY run ORDER BY seq DESC) <= 3 THEN 'full' ELSE 'summary' END AS detail FROM s")
def iteration_recent_n(spark, d):
    return lineage.recent(scores(spark, d)).select("seq", "detail")


_SHARE = "round_even({} * 100 / greatest(seq % 100 + seq % 53, 1), 0)::BIGINT"
_ENTRY = f"""'## Iteration ' || seq || ' — ' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || chr(10) || chr(10) || '### Dataset' || chr(10) || '- Dgold: ' || seq % 100 || ' (' || {_SHARE.format('(seq % 100)')} || '%)' || chr(10) || '- Dhard: ' || seq % 53 || ' (' || {_SHARE.format('(seq % 53)')} || '%)' || chr(10) || chr(10) || '### Eval results' || chr(10)
 || '- f(π_' || seq || '): ' || said || chr(10) || chr(10) || '### Iteration policy decision' || chr(10) || '- Score band: ' || band || chr(10) || '- Next intervention: ' || band || chr(10) || '- Hypothesis: more data' || chr(10) || '- Model: m'"""


@_query(f"""WITH r AS (SELECT user_id AS run, event_id AS seq, ts, event_id * 37 % 10000 AS s FROM events), q AS (SELECT *, '0.' || lpad(s::VARCHAR, 4, '0') AS said, CASE WHEN s < 8000 THEN 'data_rebuild' WHEN s < 9500 THEN 'hyperparameter' ELSE 'surgical' END AS band, row_number() OVER (PARTITION BY run ORDER BY seq DESC) AS back, count(*) OVER (PARTITION BY run) AS n FROM r),
e AS (SELECT run, seq, back, n, {_ENTRY} AS e, '- Iter ' || seq || ': f(π)=' || said || ', band=' || band || ', intervention=' || band || ', model=m — more data' AS line FROM q),
t AS (SELECT run, n, '# Log' || chr(10) || string_agg(e, chr(10) ORDER BY seq) AS t, string_agg(line, chr(10) ORDER BY seq) FILTER (back > 3) AS old, string_agg(e || CASE WHEN back > 1 THEN chr(10) ELSE '' END, chr(10) ORDER BY seq) FILTER (back <= 3) AS new FROM e GROUP BY run, n)
SELECT run, CASE WHEN n <= 3 THEN t ELSE '# Log' || chr(10) || chr(10) || '## Compacted history (older iterations)' || chr(10) || old || chr(10) || chr(10) || chr(10) || '## Recent iterations (full detail)' || chr(10) || new END AS compact, (length(t) // 4)::BIGINT AS tokens FROM t""")
def trajectory_compaction(spark, d):
    rows = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), "ts", (F.col("event_id") * 37 % 10000 / 10000).alias("score"))
    entry = lineage.iteration_entry(iteration=F.col("seq"), ts=F.col("ts"), n_gold=F.col("seq") % 100, n_hard=F.col("seq") % 53, score=F.col("score"), band=lineage.policy(F.col("score")), intervention=lineage.policy(F.col("score")), hypothesis=F.lit("more data"), model=F.lit("m"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", entry.alias("e")))), lambda x: x.e), "\n")
    return rows.groupBy("run").agg(F.concat(F.lit("# Log\n"), text).alias("t")).select("run", lineage.compact(F.col("t")).alias("compact"), T.token_estimate(F.col("t")).alias("tokens"))


# ---- devices and configurations ---------------------------------------------------------

_POOL = "pool(pos, model_id, int4_size_mb, tier, tok_s_660, tok_s_778g, tok_s_8gen3, peak_memory_mb) AS (VALUES " + ", ".join(str((k, *row)) for k, row in enumerate(hardware.POOL)) + ")"


@_query(f"WITH {_POOL} SELECT s.s_suppkey, model_id, row_number() OVER (PARTITION BY s_suppkey ORDER BY tier, int4_size_mb, pos)::BIGINT AS rank FROM pool, (SELECT 1 AS s_suppkey) s WHERE int4_size_mb <= 1100 AND peak_memory_mb <= 1300")
def pool_filter(spark, d):
    return hardware.feasible(hardware.pool(spark), 1100, 1300).select(F.lit(1).alias("s_suppkey"), "model_id", F.col("rank").cast("bigint").alias("rank"))


_CHIP = "CASE s_suppkey % 4 WHEN 0 THEN 'snapdragon_660' WHEN 1 THEN 'snapdragon_778g' WHEN 2 THEN 'snapdragon_8gen3' ELSE 'other' END"


@_query(f"WITH {_POOL}, s AS (SELECT s_suppkey, 200 + s_suppkey * 15 AS mb, {_CHIP} AS chip FROM supplier), x AS (SELECT *, CASE chip WHEN 'snapdragon_660' THEN tok_s_660 WHEN 'snapdragon_8gen3' THEN tok_s_8gen3 ELSE tok_s_778g END::DOUBLE AS tok_s FROM pool, s) SELECT s_suppkey, model_id, int4_size_mb <= mb AS storage_pass, peak_memory_mb <= mb AS memory_pass, tok_s, round_even(1000 / tok_s, 0)::BIGINT AS ttft_ms, 1000 / tok_s <= 100 AS latency_pass, true AS power_pass FROM x")
def hw_constraint_check(spark, d):
    k = F.col("s_suppkey") % 4
    chip = F.when(k == 0, "snapdragon_660").when(k == 1, "snapdragon_778g").when(k == 2, "snapdragon_8gen3").otherwise("other")
    devices = table(spark, d, "supplier").select("s_suppkey", (200 + F.col("s_suppkey") * 15).alias("mb"), chip.alias("chip"))
    pairs = devices.crossJoin(F.broadcast(hardware.pool(spark)))
    named = pairs.withColumn("model_id", F.struct("s_suppkey", "model_id"))
    got = hardware.check(named, F.col("mb"), F.col("mb"), F.lit(100), F.col("chip"))
    return got.select("model_id.s_suppkey", "model_id.model_id", "storage_pass", "memory_pass", "tok_s", "ttft_ms", "latency_pass", "power_pass")


@_query(f"WITH {_POOL} SELECT p_partkey, tier, peak_memory_mb, CASE WHEN tier IS NULL THEN 'not in the catalogue' END AS note FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Qwen/Qwen3-0.6B' ELSE 'none/' || p_partkey END AS model_id FROM part) LEFT JOIN pool USING (model_id)")
def hardware_profile(spark, d):
    ids = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, "Qwen/Qwen3-0.6B").otherwise(F.concat(F.lit("none/"), F.col("p_partkey").cast("string"))).alias("model_id"))
    return hardware.profile(ids, hardware.pool(spark)).select("p_partkey", "tier", "peak_memory_mb", "note")


@_query(f"WITH {_POOL}, r AS (SELECT model_id, row_number() OVER (ORDER BY tier, int4_size_mb, pos) AS rank FROM pool WHERE int4_size_mb <= 1600 AND peak_memory_mb <= 2000) SELECT model_id, lead(model_id) OVER (ORDER BY rank) AS next_model FROM r")
def next_tier_lead(spark, d):
    return hardware.next_model(hardware.feasible(hardware.pool(spark), 1600, 2000))


@_query("""WITH h AS (SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN p_size END AS r0, p_size % 4 AS e0 FROM part),
x AS (SELECT p_partkey, CASE WHEN r0 IS NOT NULL THEN list_sort(list_transform([4, 8, 16, 32, 64], lambda r: {'d': abs(r - r0), 'r': r}))[1]['r'] END AS r, greatest(e0, 1) AS e FROM h)
SELECT p_partkey, 'A' AS config, r::INT AS lora_rank, 0.001::DOUBLE AS learning_rate, e::INT AS nr_epochs FROM x
UNION ALL SELECT p_partkey, 'B', CASE WHEN r IS NULL THEN 16 WHEN r = 64 THEN 64 ELSE 2 * r END::INT, CASE WHEN r IS NULL THEN 0.001::DOUBLE * 2 ELSE 0.001::DOUBLE / 2 END, CASE WHEN r IS NULL THEN e ELSE greatest(e - 1, 1) END::INT FROM x""")
def training_configs(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 > 0, F.col("p_size")).alias("lora_rank"), F.lit(0.001).alias("learning_rate"), (F.col("p_size") % 4).alias("nr_epochs"), F.lit(8).alias("batch_size"))
    return hardware.configs(p).select("p_partkey", "config", "lora_rank", "learning_rate", "nr_epochs")


# ---- costs and traces: events as usage ----------------------------------------------------

#: Micro-dollars, whole numbers, to dollars of four digits, half to even.
_DOLLARS = "(micro // 100 + CASE WHEN micro % 100 > 50 OR (micro % 100 = 50 AND micro // 100 % 2 = 1) THEN 1 ELSE 0 END) / 10000"
_USAGE = "u AS (SELECT event_id, ts, user_id, CASE WHEN event_id % 3 = 0 THEN 'search' ELSE 'llm' END AS kind, CASE WHEN event_id % 3 > 0 THEN event_id % 1000 END AS input_tokens, CASE WHEN event_id % 3 > 0 THEN event_id % 200 END AS output_tokens, 1 AS n FROM events)"


def usage(spark, d):
    llm = F.col("event_id") % 3 > 0
    return table(spark, d, "events").select("event_id", "ts", "user_id", F.when(llm, "llm").otherwise("search").alias("kind"), F.when(llm, F.col("event_id") % 1000).alias("input_tokens"), F.when(llm, F.col("event_id") % 200).alias("output_tokens"), F.lit(1).alias("n"), F.when(llm, 0).otherwise(1).alias("searches"))


@_query(f"WITH {_USAGE}, g AS (SELECT user_id, coalesce(sum(input_tokens), 0)::BIGINT AS input_tokens, coalesce(sum(output_tokens), 0)::BIGINT AS output_tokens, count(*) FILTER (kind = 'llm') AS llm_calls, count(*) FILTER (kind = 'search') AS searches FROM u GROUP BY user_id), m AS (SELECT *, input_tokens * 3 + output_tokens * 15 + searches * 5000 AS micro FROM g) SELECT * EXCLUDE (micro), {_DOLLARS} AS usd FROM m")
def cost_rollup(spark, d):
    return traces.ledger(usage(spark, d), "user_id")


@_query(f"WITH {_USAGE}, g AS (SELECT date_trunc('day', ts) AS start, coalesce(sum(input_tokens), 0)::BIGINT AS input_tokens, coalesce(sum(output_tokens), 0)::BIGINT AS output_tokens, count(*) FILTER (kind = 'search') AS searches FROM u GROUP BY 1), m AS (SELECT *, input_tokens * 3 + output_tokens * 15 + searches * 5000 AS micro FROM g) SELECT strftime(start, '%Y-%m-%d') AS day, input_tokens, output_tokens, searches, {_DOLLARS} AS usd FROM m")
def cost_windows(spark, d):
    got = costs.cost_rollup(usage(spark, d).withColumns({"input_tokens": F.coalesce("input_tokens", F.lit(0)), "output_tokens": F.coalesce("output_tokens", F.lit(0))}))
    return got.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "input_tokens", "output_tokens", "searches", "usd")


@_query("SELECT event_id, sum(value) OVER w > 50 AS over_budget FROM (SELECT event_id, user_id, floor(value) AS value FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def cost_budget_alert(spark, d):
    c = table(spark, d, "events").select("event_id", "user_id", F.floor("value").cast("double").alias("usd"))
    return traces.budget_alert(c, "user_id", "event_id").select("event_id", "over_budget")


@_query("WITH t AS (SELECT event_id, user_id, sum(event_id % 10) OVER (PARTITION BY user_id ORDER BY event_id) AS total FROM events) SELECT event_id, (total - coalesce(lag(total) OVER (PARTITION BY user_id ORDER BY event_id), 0))::BIGINT AS own FROM t")
def node_cost_delta(spark, d):
    from pyspark.sql.window import Window as W

    t = table(spark, d, "events").select("event_id", "user_id", F.sum(F.col("event_id") % 10).over(W.partitionBy("user_id").orderBy("event_id")).alias("total"))
    return traces.step_costs(t, "user_id", "event_id").select("event_id", F.col("own").cast("bigint").alias("own"))


@_query("SELECT event_type, CASE WHEN event_id % 4 > 0 THEN 'T_pass' ELSE 'T_fail' END AS part, count(*) AS n FROM events GROUP BY ALL")
def trace_partition(spark, d):
    t = table(spark, d, "events").withColumn("verdict", F.when(F.col("event_id") % 4 > 0, "pass").otherwise("fail"))
    return traces.partition(t).groupBy("event_type", "part").agg(F.count("*").alias("n"))


@_query("WITH r AS (SELECT user_id AS checkpoint, count(*) FILTER (event_id % 4 > 0 AND event_id % 11 = 0) AS regressions FROM events GROUP BY user_id) SELECT checkpoint, regressions, regressions <= 2 AS accepted FROM r")
def regression_gate(spark, d):
    e = table(spark, d, "events")
    old = e.select("event_id", (F.col("event_id") % 4 > 0).alias("ok"))
    new = e.select("event_id", F.col("user_id").alias("checkpoint"), (F.col("event_id") % 11 > 0).alias("ok"))
    return traces.regressions(old, new, "event_id", by="checkpoint")


@_query("WITH r AS (SELECT (event_id % 100) / 100 AS conf, event_id % 4 > 0 AS ok FROM events), b AS (SELECT least(floor(conf * 10), 9)::INT AS bin, count(*) AS n, avg(ok::INT) AS accuracy, avg(conf) AS confidence FROM r GROUP BY 1) SELECT bin, n, round(accuracy, 9) AS accuracy, round(0.7 * accuracy + 0.3 * confidence, 9) AS calibrated FROM b")
def calibrated_confidence(spark, d):
    rows = table(spark, d, "events").select(((F.col("event_id") % 100) / 100).alias("conf"), (F.col("event_id") % 4 > 0).alias("ok"))
    return traces.calibration(rows, "conf", F.col("ok")).select("bin", "n", F.round("accuracy", 9).alias("accuracy"), F.round("calibrated", 9).alias("calibrated"))


@_query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE rn <= ceil(0.15 * n)")
def replay_stratified_sample(spark, d):
    return traces.replay(table(spark, d, "events").select("event_id", "event_type"), "event_id", "event_type").select("event_id")


@_query("SELECT event_type, count(*) AS probes, round(avg((value > 10)::INT), 9) AS fail_rate, avg((value > 10)::INT) > 0.5 AS systematic FROM events GROUP BY 1")
def probe_confirmation(spark, d):
    got = traces.systematic(table(spark, d, "events"), "event_type", F.col("value") > 10)
    return got.withColumn("fail_rate", F.round("fail_rate", 9))


@_query(f"WITH {_BINARY}, c AS (SELECT label, count(*) AS n, count(*) FILTER (doc_id % 3 = 0) AS hard FROM b GROUP BY label) SELECT max(n) AS largest, min(n) AS smallest, sum(hard)::BIGINT AS hard, sum(hard) > 0 AND max(n) <= 3 * min(n) AS accepted FROM c")
def pretraining_gate(spark, d):
    rows = binary_rows(spark, d).withColumn("origin", F.when(F.col("doc_id") % 3 == 0, "hard").otherwise("gold"))
    return traces.trainable(rows)


@_query("WITH c AS (SELECT user_id AS run, event_id AS candidate, value AS score FROM events WHERE event_id % 5 <= 2) SELECT run, candidate, score FROM c QUALIFY row_number() OVER (PARTITION BY run ORDER BY score DESC, candidate) = 1")
def constrained_best(spark, d):
    c = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("candidate"), F.col("value").alias("score"), (F.col("event_id") % 5).alias("regressions"))
    return traces.best_candidate(c, "run")


@_query("WITH s AS (SELECT lang AS label, array_to_string(list_transform(string_split(coalesce(text, ''), ' ')[1:4], lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN 'd' WHEN regexp_matches(w, '^[A-Z]+$') THEN 'U' WHEN regexp_matches(w, '^[A-Z]') THEN 'C' ELSE 'l' END), '') AS sig FROM documents) SELECT label, count(DISTINCT sig) AS patterns FROM s GROUP BY label")
def surface_pattern_counts(spark, d):
    return traces.surface_patterns(language_rows(spark, d))


@_query("WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), p AS (SELECT q.vec_id, v.vec_id AS other, list_dot_product(v.e, q.e) / sqrt(list_dot_product(v.e, v.e) * list_dot_product(q.e, q.e)) AS cosine FROM v q JOIN v ON v.label <> q.label WHERE q.vec_id % 50 = 0) SELECT vec_id, other, round(cosine, 9) AS cosine FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p.cosine DESC, other) = 1")
def boundary_neighbours(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    got = traces.nearest_other(v, "vec_id", "embedding", "label", v.where("vec_id % 50 = 0"))
    return got.withColumn("cosine", F.round("cosine", 9))

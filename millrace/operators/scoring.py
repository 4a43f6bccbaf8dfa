"""Evaluation of a model on an evaluation set: prompts, batched inference, extraction, scores.

A model is a function from a prompt to a text (or to a `Reply`, which also says what it
cost); a loader makes it from a weights reference, once in each worker.  Prompts,
extraction and scores are expressions by task type; a score reads its predictions once and
ends in a single aggregate, so that no model is asked twice for one result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from millrace.functions import text as T
from millrace.operators import metrics
from millrace.shipping import ship

#: Models that a worker keeps.
CACHED = 3


@dataclass(frozen=True)
class Reply:
    """A model's output with its usage."""

    text: str
    input_tokens: int | None = None
    output_tokens: int | None = None


Model = Callable[[str], "str | Reply"]
Loader = Callable[[str], Model]


class ModelCache:
    """The last models loaded, by loader and weights; the one loaded first goes first.

    A loader reaches a worker as a copy with every task, so it is known by its code: what
    makes its models differ belongs into the weights reference.
    """

    def __init__(self, most: int = CACHED):
        self.most, self.models = most, {}

    def get(self, load: Loader, weights: str) -> Model:
        key = (load.__module__, load.__qualname__, getattr(load, "__code__", None), weights)
        if key not in self.models:
            while len(self.models) >= self.most:
                del self.models[next(iter(self.models))]
            self.models[key] = load(weights)
        return self.models[key]


_cache = ModelCache()


def infer(rows: DataFrame, prompt: Column, load: Loader, weights: Column | str, out: str = "raw", usage: bool = False) -> DataFrame:
    """Rows with a model's output to `prompt` (null: empty) as `out`; usage: with input_tokens and output_tokens as well."""
    ship(rows.sparkSession)
    named = rows.withColumn("_prompt", F.coalesce(prompt, F.lit(""))).withColumn("_weights", F.lit(weights) if isinstance(weights, str) else weights)
    more = [S.StructField(out, S.StringType())] + [S.StructField(n, S.LongType()) for n in ("input_tokens", "output_tokens") if usage]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [_cache.get(load, w)(p) for p, w in zip(batch.column("_prompt").to_pylist(), batch.column("_weights").to_pylist(), strict=True)]
            said = [s if isinstance(s, Reply) else Reply(s) for s in said]
            keep = [n for n in batch.schema.names if n not in ("_prompt", "_weights")]
            new = [pa.array([s.text for s in said], pa.string())]
            if usage:
                new += [pa.array([s.input_tokens for s in said], pa.int64()), pa.array([s.output_tokens for s in said], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], *new], [*keep, *[f.name for f in more]])

    return named.mapInArrow(answer, S.StructType([*rows.schema.fields, *more]))


def usage_events(answered: DataFrame, ts: Column) -> DataFrame:
    """One usage event for each call, as `traces.ledger` reads them; unknown token counts are 0."""
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    return answered.select(ts.alias("ts"), F.lit("llm").alias("kind"), count("input_tokens").alias("input_tokens"), count("output_tokens").alias("output_tokens"), F.lit(1).alias("n"))


# ---- by task type ----------------------------------------------------------------------

def _question(rows: DataFrame) -> Column:
    return F.coalesce("text", F.lit(""))


def _gold_answer(rows: DataFrame) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in ("answer", "label") if c in rows.columns], F.lit(""))


def _labels_in(rows: DataFrame, raw: str) -> DataFrame:
    labels = rows.agg(F.collect_set("label").alias("_labels"))
    return rows.crossJoin(F.broadcast(labels)).withColumn("predicted", T.extract_label(F.col(raw), F.col("_labels"))).drop("_labels")


@dataclass(frozen=True)
class Scorer:
    """How a task type asks, reads answers and scores them.

    prompt: rows to the prompt.  extract: rows with `raw` to rows with `predicted`.
    right: whether a prediction counts as right in its slice.  f1, per_class: aggregates
    over the predictions.  failed: predictions that are failures.
    """

    prompt: Callable[[DataFrame], Column]
    extract: Callable[[DataFrame, str], DataFrame]
    right: Callable[[], Column]
    f1: Callable[[], Column]
    per_class: Callable[[], Column]
    failed: Callable[[], Column]


def _confusion() -> Column:
    """All (label, predicted, n) of an aggregate's rows: a list as long as there are such pairs of labels."""
    return F.col("_confusion")


def _class_f1() -> Column:
    """A list of (label, support, f1) from the confusion counts, by label."""
    c = _confusion()
    total = lambda which: F.aggregate(F.filter(c, which), F.lit(0).cast("bigint"), lambda z, x: z + x.n)

    def one(label: Column) -> Column:
        tp = total(lambda x: (x.label == label) & x.predicted.eqNullSafe(label))
        support, guesses = total(lambda x: x.label == label), total(lambda x: x.predicted.eqNullSafe(label) & x.label.isNotNull())
        return F.struct(label.alias("label"), support.alias("support"), metrics.f1(tp, guesses - tp, support - tp).alias("f1"))

    return F.transform(F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda x: x.label), lambda x: x.isNotNull()))), one)


def _headline() -> Column:
    per = _class_f1()
    mean = F.aggregate(per, F.lit(0.0), lambda z, x: z + x.f1) / F.size(per)
    rarest = F.array_min(F.transform(per, lambda x: F.struct(x.support.alias("support"), x.label.alias("label"), x.f1.alias("f1")))).f1
    return F.when(F.size(per) > 2, mean).otherwise(F.coalesce(rarest, F.lit(0.0)))


def _spans(name: str) -> Column:
    return F.array_distinct(F.coalesce(F.col(name), F.array().cast(T.SPAN)))


def _entity_micro() -> Column:
    g, p = _spans("entities"), _spans("predicted")
    total = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    tp = F.size(F.array_intersect(g, p))
    return metrics.f1(total(tp), total(F.size(p) - tp), total(F.size(g) - tp))


def _differ() -> Column:
    canon = lambda n: F.array_sort(_spans(n))
    return canon("entities") != canon("predicted")


SCORERS: dict[str, Scorer] = {
    "classification": Scorer(
        prompt=lambda rows: F.concat(F.lit(T.CLASSIFY_PROMPT), _question(rows)),
        extract=_labels_in,
        right=lambda: F.col("predicted").eqNullSafe(F.col("label")),
        f1=_headline,
        per_class=lambda: F.map_from_entries(F.transform(_class_f1(), lambda x: F.struct(x.label, x.f1))),
        failed=lambda: ~F.col("predicted").eqNullSafe(F.col("label")),
    ),
    "NER": Scorer(
        prompt=lambda rows: F.concat(F.lit(T.NER_PROMPT), _question(rows)),
        extract=lambda rows, raw: rows.withColumn("predicted", T.spans_of(F.col(raw))),
        right=lambda: (F.size(_spans("entities")) > 0) == (F.size(_spans("predicted")) > 0),
        f1=_entity_micro,
        per_class=lambda: F.create_map(F.lit("entity_f1"), _entity_micro()),
        failed=_differ,
    ),
    "generation": Scorer(
        prompt=lambda rows: F.concat(F.lit(T.GENERATE_PROMPT), _question(rows)),
        extract=lambda rows, raw: rows.withColumn("predicted", T.strip(F.col(raw))),
        right=lambda: F.col("judge_score") >= 0.5,
        f1=lambda: F.coalesce(F.avg("judge_score"), F.lit(0.0)),
        per_class=lambda: F.create_map(F.lit("judge_score"), F.coalesce(F.avg("judge_score"), F.lit(0.0))),
        failed=lambda: F.col("judge_score") < 0.5,
    ),
}


def scorer(task: str) -> Scorer:
    if task not in SCORERS:
        raise ValueError(f"task must be one of {tuple(SCORERS)}, not {task!r}")
    return SCORERS[task]


def judge(answered: DataFrame, load: Loader, weights: str = "judge") -> DataFrame:
    """Rows with judge_score: a second model's number for question, gold and predicted answer; anything else is 0."""
    prompt = T.judge_prompt(_question(answered), _gold_answer(answered), F.coalesce("predicted", F.lit("")))
    return infer(answered, prompt, load, weights, "_reply").withColumn("judge_score", metrics.judge_scores(F.col("_reply"))).drop("_reply")


def predict(rows: DataFrame, task: str, load: Loader, weights: Column | str, judge_load: Loader | None = None) -> DataFrame:
    """Evaluation rows with raw and predicted (generation: judge_score too).  Write them once if both score and failures are wanted."""
    how = scorer(task)
    if task == "generation" and judge_load is None:
        raise ValueError("generation is scored by a judge: give judge_load")
    got = how.extract(infer(rows, how.prompt(rows), load, weights), "raw")
    return judge(got, judge_load) if task == "generation" else got


def score(predicted: DataFrame, task: str, slice: str = "slice") -> DataFrame:
    """One row: f1, per_class (a map), pos_score, neg_score, boundary_score (an empty slice: 0) and n_failures."""
    how = scorer(task)
    part = lambda name: F.coalesce(F.avg(F.when(F.col(slice) == name, F.coalesce(how.right(), F.lit(False)).cast("double"))), F.lit(0.0))
    rates = [part(s).alias(f"{s}_score") for s in metrics.SLICES]
    failed = F.count_if(F.coalesce(how.failed(), F.lit(True))).alias("n_failures")
    if task != "classification":
        return predicted.agg(how.f1().alias("f1"), how.per_class().alias("per_class"), *rates, failed)
    # Pairs of labels are counted first, so what meets in one row is as small as the confusion matrix
    names = [f"{s}_score" for s in metrics.SLICES]
    of = {s: F.col(slice) == s for s in metrics.SLICES}
    hit = F.coalesce(how.right(), F.lit(False))
    counted = predicted.groupBy("label", "predicted").agg(F.count("*").alias("n"), *[F.count_if(c).alias(f"_n_{s}") for s, c in of.items()], *[F.count_if(c & hit).alias(f"_r_{s}") for s, c in of.items()], F.count_if(~hit).alias("_failed"))
    whole = counted.agg(F.collect_list(F.struct("label", "predicted", "n")).alias("_confusion"), *[F.coalesce(F.sum(f"_r_{s}") / F.nullif(F.sum(f"_n_{s}"), F.lit(0)), F.lit(0.0)).alias(n) for s, n in zip(metrics.SLICES, names, strict=True)], F.coalesce(F.sum("_failed"), F.lit(0)).alias("n_failures"))
    return whole.select(how.f1().alias("f1"), how.per_class().alias("per_class"), *names, "n_failures")


def failures(predicted: DataFrame, task: str) -> DataFrame:
    """The predictions that failed, with all their columns."""
    return predicted.where(F.coalesce(scorer(task).failed(), F.lit(True)))


def evaluate(rows: DataFrame, task: str, load: Loader, weights: Column | str, judge_load: Loader | None = None) -> DataFrame:
    """Score of a model on an evaluation set."""
    return score(predict(rows, task, load, weights, judge_load), task)


# ---- examples made by a model ------------------------------------------------------------


def counterexample_prompt(rows: DataFrame, task: str, target: Column, pattern: str = "") -> Column:
    """What is asked for a row's counterexample; of its entities the first five are named."""
    text = F.coalesce("text", F.lit(""))
    if task == "classification":
        hint = f"\nThe failure to aim at: {pattern}" if pattern else ""
        return F.concat(F.lit("Write a text that looks like the one below, which is labelled '"), F.coalesce("label", F.lit("unknown")), F.lit("', but really means '"), target, F.lit(f"'.{hint}\n\nText: "), text, F.lit("\n\nReply with the new text only."))
    if task == "NER":
        named = F.array_join(F.transform(F.slice(F.coalesce("entities", F.array().cast(T.SPAN)), 1, 5), lambda e: F.concat(F.lit('"'), F.coalesce(e.text, F.lit("")), F.lit('" ('), F.coalesce(e.type, F.lit("")), F.lit(")"))), ", ")
        return F.concat(F.lit("Rewrite the passage so that its entities stay but mean something of another type.\n\nEntities: "), F.when(named == "", "unknown entities").otherwise(named), F.lit("\nPassage: "), text, F.lit('\n\nReply with JSON only: {"text": ..., "entities": [{"text": ..., "type": ...}]}'))
    question, gold = _pair(rows)
    return F.concat(F.lit("Give a wrong answer that sounds right, with one subtle mistake.\n\nQuestion: "), question, F.lit("\nRight answer: "), gold, F.lit("\n\nReply with the wrong answer only."))


def _pair(rows: DataFrame) -> tuple[Column, Column]:
    """Question and answer of a generation row."""
    of = lambda *names: F.coalesce(*[F.col(n) for n in names if n in rows.columns], F.lit(""))
    return of("prompt", "text"), of("response", "label", "answer")


def synthesize(rows: DataFrame, order: str, n: int, load: Loader, task: str, weights: str = "generator", pattern: str = "") -> DataFrame:
    """The first n rows (origin hard_orig), each with one counterexample that a model writes (hard_syn).

    Columns: order, text, label, entities, prompt, response, origin.  classification: the
    model's text under the least other label (its own if there is none).  NER: the text and
    spans of the model's JSON; what can't be read gives its raw text without spans.
    generation: the row's question with the model's answer.
    """
    have = lambda name, kind: (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)
    wide = rows.select(order, have("text", "string"), have("label", "string"), have("entities", T.SPAN), have("prompt", "string"), have("response", "string"), have("answer", "string"))
    first = wide.orderBy(order).limit(n)
    labels = first.agg(F.array_sort(F.collect_set("label")).alias("_labels"))
    other = F.try_element_at(F.filter("_labels", lambda x: x != F.col("label")), F.lit(1))
    first = first.crossJoin(F.broadcast(labels)).withColumn("_target", F.coalesce(other, "label", F.lit("unknown"))).drop("_labels")
    made = infer(first, counterexample_prompt(first, task, F.col("_target"), pattern), load, weights, "_raw")
    raw = T.strip(F.col("_raw"))
    none, no_spans = F.lit(None).cast("string"), F.lit(None).cast(T.SPAN)
    row = lambda text, label, entities, prompt, response, origin: F.struct(text.alias("text"), label.alias("label"), entities.alias("entities"), prompt.alias("prompt"), response.alias("response"), F.lit(origin).alias("origin"))
    own = row(F.col("text"), F.col("label"), F.col("entities"), F.col("prompt"), F.col("response"), "hard_orig")
    if task == "classification":
        new = row(raw, F.col("_target"), no_spans, none, none, "hard_syn")
    elif task == "NER":
        read = T.json_object(raw, f"text string, entities {T.SPAN}")
        new = row(F.coalesce(read.text, raw), none, T.whole_spans(F.coalesce(read.entities, F.array().cast(T.SPAN))), none, none, "hard_syn")
    elif task == "generation":
        new = row(none, none, no_spans, _pair(made)[0], raw, "hard_syn")
    else:
        raise ValueError(f"task must be one of {tuple(SCORERS)}, not {task!r}")
    return made.select(order, F.explode(F.array(own, new)).alias("x")).select(order, "x.*")


def annotate(rows: DataFrame, load: Loader, weights: str = "annotator") -> DataFrame:
    """Texts (their first 500 characters) with the entities that a model reads in them; what can't be read has none."""
    ask = F.concat(F.lit('List the named entities of this text as JSON objects with "text" and "type"; [] if there are none.\n\nText: '), F.substring("text", 1, 500))
    return infer(rows, ask, load, weights, "_raw").withColumn("entities", T.spans_of(T.strip(F.col("_raw")), greedy=True)).drop("_raw")

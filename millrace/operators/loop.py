"""The improvement loop: curate, evaluate, decide, roll back, escalate.

Each step exists as a relation over many runs at once (a row or a few rows a run), and the
driver's loop of one run is put together from them.  Datasets are DataFrames all the way;
what the driver holds is the run's own short history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import text as T
from millrace.operators import controls, lineage, scoring

INTERVENTIONS = ("data_rebuild", "hyperparameter", "surgical")
# What a fallback says of each band, and when a run stops.
FALLBACK = {
    "data_rebuild": "(fallback) Score below 0.80 — data problem. Rebuild dataset.",
    "hyperparameter": "(fallback) Score 0.80–0.95 — optimization problem. Tune hyperparameters.",
    "surgical": "(fallback) Score ≥0.95 — add 2–3 targeted examples per remaining failure pattern.",
}
INCREASES, STEPS, TURNS = 3, 40, 1500

_DECISION = "intervention string, hypothesis string, hyperparams struct<lora_rank:int,learning_rate:double,nr_epochs:int,batch_size:int>, targeted_patterns string"


# ---- curate ----------------------------------------------------------------------------


def sources(failures: DataFrame, train: DataFrame, order: str, n: int) -> DataFrame:
    """n examples to make counterexamples of: failures first, then training rows, each in order; with their rank in `pos`."""
    names = [c for c in train.columns if c in failures.columns]
    both = failures.orderBy(order).limit(n).select(F.lit(0).alias("_p"), *names).unionByName(train.orderBy(order).limit(n).select(F.lit(1).alias("_p"), *names))
    # 2n rows at most
    return both.withColumn("pos", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("_p", order)).cast("bigint")).where(F.col("pos") <= n).drop("_p")


def curate(train: DataFrame, evaluation: DataFrame, failures: DataFrame, order: str, task: str, load: scoring.Loader, intervention: str = "data_rebuild", existing: DataFrame | None = None, pattern: str = "", compat: bool = False) -> DataFrame:
    """A training set's next version, with origin (gold, hard_orig, hard_syn) and a new order column `pos`.

    data_rebuild, or no version yet: 65 parts gold and 35 counterexample pairs by the task's
    budget.  surgical: the existing version and pairs of at most 20 failures.
    hyperparameter: the existing version as it is.  Evaluation texts never come back with
    hard rows unless compat.
    """
    if intervention == "hyperparameter" and existing is not None:
        return existing
    if intervention == "surgical" and existing is not None:
        n = controls.surgical_budget(failures.count())
        base, made = existing, scoring.synthesize(failures, order, n, load, task, pattern=pattern)
    else:
        total = controls.BUDGETS.get(task, controls.BUDGETS["classification"])
        n_gold = controls.gold_budget(task)
        # The gold part is chosen as a classification set whatever the task, as its rows are labelled texts
        base = controls.curriculum(train, evaluation, order, n_total=n_gold) if "label" in train.columns else controls.select_budget(controls.without_texts(train, evaluation), order, n_gold, task)
        base = base.withColumn("origin", F.lit("gold"))
        made = scoring.synthesize(sources(failures, train, order, total - n_gold), "pos", total - n_gold, load, task).withColumnRenamed("pos", order)
    merged = controls.merge_hard(base, made, evaluation, compat)
    rank = F.when(F.col("origin") == "gold", 0).when(F.col("origin") == "hard_orig", 1).otherwise(2)
    # A curriculum is some hundred rows: one group
    numbered = merged.withColumn("pos", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(rank, order, F.coalesce("text", F.lit("")))).cast("bigint"))
    return controls.quality_controls(numbered, task, "pos", compat)


def curation_counts(rows: DataFrame, n_added: int | None = None) -> DataFrame:
    """One row: n_gold, n_hard_orig, n_hard_syn, label_dist, and n_hard_reported (pairs added, at most all rows), the historic figure that counts originals as well."""
    of = lambda o: F.count_if(F.col("origin") == o)
    labels = rows.groupBy(F.coalesce("label", F.lit("?")).alias("label")).agg(F.count("*").alias("n"))
    dist = labels.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("label_dist"))
    added = F.lit(n_added) if n_added is not None else of("hard_orig") + of("hard_syn")
    counts = rows.agg(of("gold").alias("n_gold"), of("hard_orig").alias("n_hard_orig"), of("hard_syn").alias("n_hard_syn"), F.least(added, F.count("*")).cast("bigint").alias("n_hard_reported"))
    return counts.crossJoin(F.broadcast(dist))


# ---- evaluate ----------------------------------------------------------------------------


def best_config(scored: DataFrame, run: str = "run", seq: str = "seq", config: str = "config", order: str = "ord") -> DataFrame:
    """Each iteration's configuration of the highest F1, the first of equals, with all its columns."""
    rest = [c for c in scored.columns if c not in (run, seq)]
    return scored.groupBy(run, seq).agg(F.max_by(F.struct(*rest), F.struct(F.col("f1"), -F.col(order))).alias("x")).select(run, seq, "x.*")


def evaluated(scored: DataFrame, configs: DataFrame | None = None, run: str = "run", seq: str = "seq") -> DataFrame:
    """Lineage nodes of scored configurations (run, seq, ord, config, f1): the best of each iteration, its parent, the decision bands and the pipeline that made it.

    configs: (config, lora_rank, learning_rate, nr_epochs, batch_size), a small table; a
    configuration that isn't in it has nulls.
    """
    best = best_config(scored, run, seq).withColumnRenamed("f1", "score").withColumnRenamed("config", "best_config")
    kept = lineage.best_so_far(best, run, seq)
    w = W.partitionBy(run).orderBy(seq)
    nodes = kept.withColumns({"iteration": F.row_number().over(w), "intervention": lineage.policy(F.col("score")), "pruned": F.lit(False), "no_improve": F.col("no_improve").cast("bigint")})
    nodes = nodes.withColumn("parent_iteration", F.lag("iteration").over(w))
    if configs is not None:
        hyper = F.struct("lora_rank", "learning_rate", "nr_epochs", "batch_size")
        known = configs.select(F.col("config").alias("best_config"), hyper.alias("H"))
        nodes = nodes.join(F.broadcast(known), "best_config", "left").withColumn("pi", F.struct(F.struct(F.col("iteration").alias("version")).alias("D"), "H")).drop("H")
    return nodes


# ---- decide ------------------------------------------------------------------------------


def decision(raw: Column) -> Column:
    """A model's decision; null if it can't be read or names no known intervention."""
    read = T.json_object(T.unfenced(raw), _DECISION)
    return F.when(read.intervention.isin(*INTERVENTIONS), read)


def decided(nodes: DataFrame, raw: Column, stop: Column) -> DataFrame:
    """Adds intervention, hypothesis, pattern and next_action: the model's decision, or the score band's where it has none."""
    band = lineage.policy(F.col("score"))
    says = F.create_map(*[F.lit(x) for pair in FALLBACK.items() for x in pair])
    got = nodes.withColumn("_said", decision(raw))
    got = got.withColumns({"intervention": F.coalesce("_said.intervention", band), "hypothesis": F.when(F.col("_said").isNull(), F.try_element_at(says, band)).otherwise(F.coalesce("_said.hypothesis", F.lit(""))), "pattern": F.coalesce("_said.targeted_patterns", F.lit(""))})
    return got.withColumn("next_action", lineage.next_action(F.col("score"), stop, F.col("no_improve"), F.col("intervention"))).drop("_said")


def trajectory_for(log: Column, limit: int = 8000) -> Column:
    """What a model is shown of a log: compacted once its estimated tokens are over the limit."""
    return F.when(too_long(log, limit), lineage.compact(log)).otherwise(F.when(F.length(F.coalesce(log, F.lit(""))) > 0, log).otherwise("(no iterations logged yet)"))


def too_long(log: Column, limit: int = 8000) -> Column:
    return T.token_estimate(log) > limit


def failure_summary(failed: DataFrame, order: str, first: int = 10) -> DataFrame:
    """One row: a line for each of the first failures."""
    have = lambda *names: [F.col(n) for n in names if n in failed.columns]
    gold = [c if n != "entities" else F.to_json(c) for n, c in zip([n for n in ("label", "entities", "response") if n in failed.columns], have("label", "entities", "response"), strict=True)]
    line = T.failure_line(F.col("predicted"), gold, have("text", "prompt"))
    head = failed.select(F.col(order).alias("o"), line.alias("line")).orderBy("o").limit(first)
    return head.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "line"))), lambda x: x.line), "\n").alias("failures"))


def convergence(score: Column, no_improve: Column, turns: Column, tiers_left: Column, target: float = 0.96) -> Column:
    """Why a run ends, the first reason that holds; null: it goes on."""
    return F.when(score >= target, "promote").when(no_improve >= 2, "plateau").when(turns >= TURNS, "turns exhausted").when(tiers_left <= 0, "capacity ceiling")


def steps_until_stop(steps: DataFrame, run: str = "run", seq: str = "seq", score: str = "score", increases: int = INCREASES, most: int = STEPS) -> DataFrame:
    """The steps that a run takes before its best score has risen `increases` times (that step included), `most` at most; adds step and increases."""
    w = W.partitionBy(run).orderBy(seq)
    before = F.coalesce(F.max(score).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1.0))
    rose = (F.col(score) > F.greatest(before, F.lit(-1.0)) + lineage.EPS).cast("int")
    got = steps.withColumns({"step": F.row_number().over(w).cast("bigint"), "_rose": rose}).withColumn("increases", F.sum("_rose").over(w))
    return got.where((F.col("increases") - F.col("_rose") < increases) & (F.col("step") <= most)).drop("_rose")


# ---- one run on the driver ---------------------------------------------------------------


@dataclass
class Run:
    """A run's history: its scores that stand, its nodes, and what comes next."""

    stop: float = 0.96
    model: int = 0
    n_models: int = 1
    iteration: int = 0
    best: float = 0.0
    best_weights: str | None = None
    no_improve: int = 0
    scores: list[float] = field(default_factory=list)
    dag: list[dict] = field(default_factory=list)
    version: int = 0
    intervention: str = ""
    action: str = "curate"


def drive(run: Run, curate_step: Callable[[Run], None], train_step: Callable[[Run], dict[str, str]], score_step: Callable[[str], float], increases: int = INCREASES, most: int = STEPS) -> Iterator[tuple[str, Run]]:
    """Runs curate, train, evaluate, roll back, decide and escalate in turn, and yields (step, run) after each.

    Ends when the run says terminate, its best score has risen `increases` times or `most`
    steps are over.  A regression counts twice as no improvement (when it is scored and when
    it is rolled back).
    """
    seen, steps, rose = -1.0, 0, 0
    weights: dict[str, str] = {}
    while run.action != "terminate" and steps < most:
        step = run.action
        if step == "curate":
            run.version += 1
            curate_step(run)
            run.action = "train"
        elif step == "train":
            run.iteration += 1
            weights = train_step(run)
            run.action = "evaluate"
        elif step == "evaluate":
            scored = {name: score_step(ref) for name, ref in weights.items()}
            name = max(scored, key=scored.__getitem__)
            now = scored[name]
            if now > run.best:
                run.best, run.best_weights, run.no_improve = now, weights[name], 0
            else:
                run.no_improve += 1
            run.scores.append(now)
            run.dag.append({"iteration": run.iteration, "parent_iteration": run.dag[-1]["iteration"] if run.dag else None, "score": now, "best_config": name, "weights": weights[name], "version": run.version, "pruned": False})
            run.action = "rollback" if len(run.scores) > 1 and run.scores[-1] < run.scores[-2] else "iterate"
        elif step == "rollback":
            run.scores.pop()
            run.dag[-1]["pruned"] = True
            run.no_improve += 1
            alive = max((n for n in run.dag if not n["pruned"]), key=lambda n: n["score"])
            run.best, run.best_weights, run.action = alive["score"], alive["weights"], "iterate"
        elif step == "iterate":
            now = run.scores[-1]
            run.intervention = next((name for below, name in lineage.SCORE_BANDS if now < below), "surgical")
            run.action = "terminate" if now >= run.stop else "escalate" if run.no_improve >= 2 else "train" if run.intervention == "hyperparameter" else "curate"
        elif step == "escalate":
            run.action = "curate" if run.model + 1 < run.n_models else "terminate"
            if run.action == "curate":
                run.model, run.iteration, run.best, run.best_weights, run.no_improve, run.scores, run.dag = run.model + 1, 0, 0.0, None, 0, [], []
        steps += 1
        yield step, run
        if step == "evaluate" and run.best > seen + lineage.EPS:
            seen, rose = run.best, rose + 1
            if rose >= increases:
                return


def checkpoint_folder(iteration: Column, label: Column) -> Column:
    """Folder of a trained configuration: the iteration and what its label says before the colon."""
    return F.concat(F.lit("iter"), iteration.cast("string"), F.lit("_"), T.strip(F.split_part(label, F.lit(":"), F.lit(1))))

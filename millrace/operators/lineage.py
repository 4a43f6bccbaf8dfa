"""Runs, scores and decisions: the lineage table and what is read from it.

A run's history is short (tens of rows a run), but tables hold many runs: everything here
is grouped or windowed by `run`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace import tables
from millrace.functions import text as T

SCORE_BANDS = ((0.80, "data_rebuild"), (0.95, "hyperparameter"))
GATE = 2
EPS = 1e-9


def policy(score: Column) -> Column:
    """Intervention for a score."""
    (a, low), (b, mid) = SCORE_BANDS
    return F.when(score < a, low).when(score < b, mid).otherwise("surgical")


def next_action(score: Column, stop: Column, no_improve: Column, intervention: Column) -> Column:
    """What follows an evaluation; no score yet means training."""
    return F.when(score.isNull(), "train").when(score >= stop, "terminate").when(no_improve >= 2, "escalate").when(intervention == "hyperparameter", "train").otherwise("curate")


def best_so_far(scores: DataFrame, run: str = "run", seq: str = "seq", score: str = "score") -> DataFrame:
    """Adds best_before, improved (strictly better than all before) and no_improve (rows since then)."""
    w = W.partitionBy(run).orderBy(seq)
    before = F.max(score).over(w.rowsBetween(W.unboundedPreceding, -1))
    got = scores.withColumn("best_before", before).withColumn("improved", F.col("best_before").isNull() | (F.col(score) > F.col("best_before")))
    island = F.sum(F.col("improved").cast("int")).over(w)
    got = got.withColumn("_island", island)
    return got.withColumn("no_improve", F.row_number().over(W.partitionBy(run, "_island").orderBy(seq)) - 1).drop("_island")


def improvements(scores: DataFrame, run: str = "run", seq: str = "seq", score: str = "score") -> DataFrame:
    """(run, improvements): how often the running maximum, from -1, rises by more than a hair."""
    fold = F.aggregate(F.array_sort(F.collect_list(F.struct(seq, score))), F.struct(F.lit(-1.0).alias("best"), F.lit(0).alias("n")), lambda z, x: F.when(x[score] > z.best + EPS, F.struct(x[score].alias("best"), (z.n + 1).alias("n"))).otherwise(z))
    return scores.groupBy(run).agg(fold.n.alias("improvements"))


def rollback_fold(scores: DataFrame, run: str = "run", seq: str = "seq", score: str = "score") -> DataFrame:
    """(run, accepted, rollbacks, best, no_improve): scores in order; one below the last accepted is rolled back.

    A rolled-back score counts twice as no improvement, once when it is scored and once
    when it is rolled back.
    """
    start = F.struct(F.array().cast("array<double>").alias("accepted"), F.lit(0).alias("rollbacks"), F.lit(None).cast("double").alias("best"), F.lit(0).alias("no_improve"))

    def step(z: Column, x: Column) -> Column:
        s = x[score]
        better = z.best.isNull() | (s > z.best)
        worse = F.coalesce(s < F.try_element_at(z.accepted, F.lit(-1)), F.lit(False))
        return F.struct(
            F.when(worse, z.accepted).otherwise(F.concat(z.accepted, F.array(s))).alias("accepted"), (z.rollbacks + worse.cast("int")).alias("rollbacks"),
            F.when(better, s).otherwise(z.best).alias("best"), F.when(better, F.lit(0)).otherwise(z.no_improve + 1 + worse.cast("int")).alias("no_improve"),
        )

    return scores.groupBy(run).agg(F.aggregate(F.array_sort(F.collect_list(F.struct(seq, F.col(score).cast("double").alias(score)))), start, step).alias("x")).select(run, "x.*")


def should_rollback(scores: Column) -> Column:
    """Whether the last score of an array is below the one before."""
    return F.coalesce(F.try_element_at(scores, F.lit(-1)) < F.try_element_at(scores, F.lit(-2)), F.lit(False)) & (F.size(scores) > 1)


def with_parent(dag: DataFrame, run: str = "run", seq: str = "seq") -> DataFrame:
    """Adds the iteration and score of the node appended before, pruned or not."""
    w = W.partitionBy(run).orderBy(seq)
    return dag.withColumns({"parent_iteration": F.lag("iteration").over(w), "parent_score": F.lag("score").over(w)})


def best_node(dag: DataFrame, run: str = "run", seq: str = "seq") -> DataFrame:
    """Each run's best node that isn't pruned, the first of equals."""
    alive = dag.where(~F.coalesce("pruned", F.lit(False)))
    return alive.groupBy(run).agg(F.max_by(F.struct("iteration", "score"), F.struct("score", -F.col(seq))).alias("x")).select(run, F.col("x.iteration").alias("iteration"), F.col("x.score").alias("score"))


def backpropagate(nodes: DataFrame, id: str = "id", parent: str = "parent_id", score: str = "score") -> DataFrame:
    """(id, visits, mean_score): every node's score counts for itself and all its ancestors.

    Sums double their reach each round: a node that holds the sums of all below it within
    2**k steps gets those of the nodes exactly 2**k below it.  So a tree of depth d takes
    log2(d) rounds of one row a node, never pairs of nodes and ancestors.
    """
    state = nodes.select(F.col(id).alias("id"), F.col(parent).alias("up"), F.lit(1).cast("bigint").alias("n"), F.col(score).isNotNull().cast("bigint").alias("m"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("s"))
    while True:
        below = state.where("up is not null")
        if below.isEmpty():
            return state.select("id", F.col("n").alias("visits"), (F.col("s") / F.nullif(F.col("m"), F.lit(0))).alias("mean_score"))
        gain = below.groupBy(F.col("up").alias("id")).agg(*[F.sum(c).alias(f"{c}_") for c in "nms"])
        far = state.select(F.col("id").alias("up"), F.col("up").alias("far"))
        grown = state.join(far, "up", "left").join(gain, "id", "left")
        new = tables.table(grown.select("id", F.col("far").alias("up"), *[(F.col(c) + F.coalesce(f"{c}_", F.lit(0))).alias(c) for c in "nms"]), "sums")
        if state is not nodes:
            tables.drop(state)
        state = new


def uct(children: DataFrame, c: float = 1.4142135623730951, group: str = "parent_id") -> DataFrame:
    """Adds uct = mean + c * sqrt(ln N / n) and chosen, the largest of each parent (least id of equals)."""
    total = F.sum("visits").over(W.partitionBy(group))
    got = children.withColumn("uct", F.col("mean_score") + c * F.sqrt(F.log(total.cast("double")) / F.col("visits")))
    return got.withColumn("chosen", F.row_number().over(W.partitionBy(group).orderBy(F.desc("uct"), "id")) == 1)


def top_k(nodes: DataFrame, k: int = 3, run: str = "run", id: str = "iteration", score: str = "score") -> DataFrame:
    """Each run's k best nodes that aren't pruned, with their rank (least id of equals)."""
    rank = F.row_number().over(W.partitionBy(run).orderBy(F.desc(score), id))
    return nodes.where(~F.coalesce("pruned", F.lit(False))).withColumn("rank", rank).where(F.col("rank") <= k)


def fusions(nodes: DataFrame, k: int = 3, run: str = "run", branch: str = "branch", id: str = "iteration", score: str = "score") -> DataFrame:
    """(run, a, b, gain): pairs of a run's best nodes (of each branch the k best) in different branches, a the better one; gain: what b's score lacks."""
    best = top_k(nodes.withColumn("_of", F.struct(run, branch)), k, "_of", id, score)
    side = lambda x: best.select(run, F.col(branch).alias(f"{branch}_{x}"), F.col(id).alias(x), F.col(score).alias(f"s{x}"))
    pairs = side("a").join(side("b"), run).where((F.col(f"{branch}_a") != F.col(f"{branch}_b")) & ((F.col("sa") > F.col("sb")) | ((F.col("sa") == F.col("sb")) & (F.col("a") < F.col("b")))))
    return pairs.select(run, "a", "b", (F.col("sa") - F.col("sb")).alias("gain"))


def exploration(t: Column, start: float = 1.4142135623730951, half: float = 10.0) -> Column:
    """Exploration weight at iteration t: halves every `half` iterations."""
    return F.lit(start) * F.pow(F.lit(0.5), t / half)


def recent(log: DataFrame, n: int = 3, run: str = "run", seq: str = "seq") -> DataFrame:
    """Adds detail: 'full' for a run's last n rows, else 'summary'."""
    return log.withColumn("detail", F.when(F.row_number().over(W.partitionBy(run).orderBy(F.desc(seq))) <= n, "full").otherwise("summary"))


def _field(section: Column, pattern: str, default: str = "?") -> Column:
    found = F.regexp_extract(section, pattern, 1)
    return F.when(found == "", default).otherwise(F.regexp_replace(found, r"(?U)^\s+|\s+$", ""))


def summary_line(section: Column) -> Column:
    """One line for a section of a trajectory; a hypothesis may stand on the line after its name."""
    why = F.substring(_field(section, r"Hypothesis:\s*(.+)", ""), 1, 100)
    line = F.concat(
        F.lit("- Iter "), _field(section, r"Iteration (\d+)"), F.lit(": f(π)="), _field(section, r"f\(π_\d+\):\s*([\d.]+)"), F.lit(", band="), _field(section, r"Score band:\s*(.+)"),
        F.lit(", intervention="), _field(section, r"Next intervention:\s*(.+)"), F.lit(", model="), _field(section, r"Model:\s*(\S+)"),
    )
    return F.when(why != "", F.concat(line, F.lit(" — "), why)).otherwise(line)


def compact(trajectory: Column, n: int = 3) -> Column:
    """A trajectory with all but its last n iterations as one line each.

    A section's place counts from the end: iterations n from it or more are told in a line,
    later ones in full, and what is no iteration stands in front.
    """
    # (?m)(?=…): a section begins where a line does
    sections = F.split(trajectory, r"(?m)(?=^## Iteration \d+)")
    told = F.transform(sections, lambda s: F.struct(F.regexp_like(s, F.lit(r"^\s*## Iteration")).alias("iteration"), s.alias("text")))
    iterations = F.filter(told, lambda x: x.iteration)
    surplus = F.size(iterations) - n
    joined = lambda which, one, by: F.array_join(F.transform(F.filter(iterations, which), one), by)
    head = T.strip(F.array_join(F.transform(F.filter(told, lambda x: ~x.iteration), lambda x: x.text), ""))
    old, new = joined(lambda x, k: k < surplus, lambda x: summary_line(x.text), "\n"), joined(lambda x, k: k >= surplus, lambda x: x.text, "\n")
    short = F.concat(head, F.lit("\n\n## Compacted history (older iterations)\n"), old, F.lit("\n\n\n## Recent iterations (full detail)\n"), new)
    return F.when(surplus > 0, short).otherwise(trajectory)


def iteration_entry(**c: Column) -> Column:
    """Markdown of one row of the iteration log."""
    total = F.greatest(c["n_gold"] + c["n_hard"], F.lit(1))
    share = lambda x: F.format_string("%.0f", F.bround(x * 100 / total, 0))
    return F.concat_ws("\n",
        F.concat(F.lit("## Iteration "), c["iteration"].cast("string"), F.lit(" — "), F.date_format(c["ts"], "yyyy-MM-dd'T'HH:mm:ss")), F.lit(""), F.lit("### Dataset"),
        F.concat(F.lit("- Dgold: "), c["n_gold"].cast("string"), F.lit(" ("), share(c["n_gold"]), F.lit("%)")), F.concat(F.lit("- Dhard: "), c["n_hard"].cast("string"), F.lit(" ("), share(c["n_hard"]), F.lit("%)")),
        F.lit(""), F.lit("### Eval results"), F.concat(F.lit("- f(π_"), c["iteration"].cast("string"), F.lit("): "), F.format_string("%.4f", c["score"])),
        F.lit(""), F.lit("### Iteration policy decision"), F.concat(F.lit("- Score band: "), c["band"]), F.concat(F.lit("- Next intervention: "), c["intervention"]), F.concat(F.lit("- Hypothesis: "), c["hypothesis"]), F.concat(F.lit("- Model: "), c["model"]))

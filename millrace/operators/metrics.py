"""Scores of predictions, as aggregates over (gold, predicted) rows.

Per-class counts come from one pass of conditional sums grouped by label, so nothing is
joined row by row but gold and prediction themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = ("pos", "neg", "boundary")


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 of counts, 0 without true positives."""
    p, r = tp / F.nullif(tp + fp, F.lit(0)), tp / F.nullif(tp + fn, F.lit(0))
    return F.when(tp == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def paired(gold: DataFrame, predicted: DataFrame, on: str = "ord") -> DataFrame:
    """Gold rows with their predictions by an explicit order column; rows without either drop out, as the shorter list decides."""
    return gold.join(predicted, on)


def binary_f1(rows: DataFrame, positive: str, gold: str = "label", predicted: str = "predicted") -> DataFrame:
    g, p = F.col(gold) == positive, F.col(predicted) == positive
    count = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("bigint")), F.lit(0))
    got = rows.agg(count(g & p).alias("tp"), count(~g & p).alias("fp"), count(g & ~p).alias("fn"))
    return got.select("tp", "fp", "fn", f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def per_class_f1(rows: DataFrame, gold: str = "label", predicted: str = "predicted") -> DataFrame:
    """(label, support, tp, fp, fn, f1) of every gold label; labels that are only predicted don't count."""
    sides = rows.select(F.explode(F.array(
        F.struct(F.col(gold).alias("label"), F.lit(1).alias("support"), (F.col(gold) == F.col(predicted)).cast("int").alias("tp"), F.lit(0).alias("guesses")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).alias("support"), F.lit(0).alias("tp"), F.lit(1).alias("guesses")),
    )).alias("x")).select("x.*")
    got = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum(F.coalesce("tp", F.lit(0))).alias("tp"), F.sum("guesses").alias("guesses")).where("support > 0 and label is not null")
    got = got.select("label", "support", "tp", (F.col("guesses") - F.col("tp")).alias("fp"), (F.col("support") - F.col("tp")).alias("fn"))
    return got.withColumn("f1", f1(F.col("tp"), F.col("fp"), F.col("fn")))


def headline_f1(rows: DataFrame, gold: str = "label", predicted: str = "predicted") -> DataFrame:
    """One row: mean F1 over more than two classes, else the F1 of the rarer one (of equals the first by name)."""
    per = per_class_f1(rows, gold, predicted)
    return per.agg(F.when(F.count("*") > 2, F.avg("f1")).otherwise(F.min_by("f1", F.struct("support", "label"))).alias("f1"), F.count("*").alias("classes"))


def entity_f1(rows: DataFrame, gold: str = "entities", predicted: str = "predicted") -> DataFrame:
    """Micro average over spans, each (text, type) once per example."""
    none = F.array().cast("array<struct<text:string,type:string>>")
    g, p = F.array_distinct(F.coalesce(gold, none)), F.array_distinct(F.coalesce(predicted, none))
    tp = F.size(F.array_intersect(g, p))
    total = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    got = rows.agg(total(tp).alias("tp"), total(F.size(p) - tp).alias("fp"), total(F.size(g) - tp).alias("fn"))
    return got.select("tp", "fp", "fn", f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def slice_accuracy(rows: DataFrame, right: Column, slice: str = "slice") -> DataFrame:
    """(slice, n, accuracy) of all three slices; an empty one has 0."""
    spark = rows.sparkSession
    all_ = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in SLICES])).alias("slice"))
    got = rows.groupBy(F.col(slice).alias("slice")).agg(F.count("*").alias("n"), F.avg(F.coalesce(right, F.lit(False)).cast("double")).alias("accuracy"))
    return F.broadcast(all_).join(got, "slice", "left").select("slice", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"))


def judge_scores(replies: Column) -> Column:
    """A judge's number; anything else is 0."""
    return F.coalesce(F.regexp_replace(replies, r"(?U)^\s+|\s+$", "").try_cast("double"), F.lit(0.0))


def failures(rows: DataFrame, gold: str = "label", predicted: str = "predicted") -> DataFrame:
    return rows.where(~F.col(predicted).eqNullSafe(F.col(gold)))


def entity_failures(rows: DataFrame, gold: str = "entities", predicted: str = "predicted") -> DataFrame:
    """Rows whose sets of (text, type) differ; order and repeats don't matter."""
    canon = lambda c: F.array_sort(F.array_distinct(c))
    return rows.where(~canon(F.col(gold)).eqNullSafe(canon(F.col(predicted))))


def failure_taxonomy(failed: DataFrame, order: str, gold: str = "label", predicted: str = "predicted", first: int = 50, most: int = 10) -> DataFrame:
    """Most frequent 'gold→predicted' patterns of the first failures; of equals the one seen first."""
    head = failed.orderBy(order).limit(first)
    pattern = F.concat(F.coalesce(gold, F.lit("?")), F.lit("→"), F.coalesce(F.col(predicted).cast("string"), F.lit("?")))
    got = head.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return got.orderBy(F.desc("n"), "seen").limit(most)


def scripted_predictions(rows: DataFrame, target: Column, order: str, label: str = "label") -> DataFrame:
    """The first round(target * n) rows right, the rest the first other label: a deterministic stand-in for a model.

    Ranks come from a range of ids and per-range counts, so no task sorts all rows.
    """
    labels = F.array_sort(F.collect_set(label))
    told = rows.agg(F.count("*").alias("n_all"), labels.alias("labels"))
    ranked = ranks(rows, order)
    other = F.coalesce(F.try_element_at(F.filter("labels", lambda x: x != F.col(label)), F.lit(1)), F.col(label))
    got = ranked.crossJoin(F.broadcast(told))
    return got.withColumn("predicted", F.when(F.col("rank") <= F.bround(target * F.col("n_all")), F.col(label)).otherwise(other)).drop("rank", "n_all", "labels")


def ranks(rows: DataFrame, order: str, name: str = "rank", parts: int = 64) -> DataFrame:
    """Rows with their 1-based rank by a unique numeric column, without a global window.

    Quantiles (that many numbers) part the rows; each part is ranked by itself, and the
    parts' counts, one row each, are prefix-summed and added.
    """
    from pyspark.sql.window import Window as W

    cuts = sorted(set(rows.approxQuantile(order, [k / parts for k in range(1, parts)], 0.001)))
    part = sum((F.when(F.col(order) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    spread = rows.withColumn("_part", part)
    local = spread.withColumn(name, F.row_number().over(W.partitionBy("_part").orderBy(order)))
    counts = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return local.join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")

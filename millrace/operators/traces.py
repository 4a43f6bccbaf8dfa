"""Usage costs and production traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import text as T
from millrace.operators import tfidf

# Dollars for a million tokens in and out, and for a search.
IN_PRICE, OUT_PRICE, SEARCH_PRICE = 3.0, 15.0, 0.005
ALERT = 50.0


def cost(tokens_in: Column, tokens_out: Column, searches: Column) -> Column:
    return tokens_in / 1e6 * IN_PRICE + tokens_out / 1e6 * OUT_PRICE + searches * SEARCH_PRICE


def dollars(tokens_in: Column, tokens_out: Column, searches: Column) -> Column:
    """Cost to four digits, half to even, from exact decimals: the rounding does not hang on the last bit of a float."""
    part = lambda c, price: F.coalesce(c, F.lit(0)).cast("decimal(20,0)") * F.lit(f"{price:.6f}").cast("decimal(10,6)")
    return F.bround(part(tokens_in, IN_PRICE / 1e6) + part(tokens_out, OUT_PRICE / 1e6) + part(searches, SEARCH_PRICE), 4).cast("double")


def ledger(usage: DataFrame, *by: str) -> DataFrame:
    """Usage events (kind 'llm' or 'search', input_tokens, output_tokens, n) to counts and dollars of four digits."""
    got = usage.groupBy(*by).agg(
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
        F.coalesce(F.sum(F.when(F.col("kind") == "llm", F.col("n"))), F.lit(0)).alias("llm_calls"), F.coalesce(F.sum(F.when(F.col("kind") == "search", F.col("n"))), F.lit(0)).alias("searches"),
    )
    return got.withColumn("usd", dollars(F.col("input_tokens"), F.col("output_tokens"), F.col("searches")))


def budget_alert(costs: DataFrame, by: str, order: str, usd: str = "usd", limit: float = ALERT) -> DataFrame:
    """Adds the running total and whether it is over the budget."""
    return costs.withColumn("running_usd", F.sum(usd).over(W.partitionBy(by).orderBy(order))).withColumn("over_budget", F.col("running_usd") > limit)


def step_costs(totals: DataFrame, by: str, order: str, total: str = "total") -> DataFrame:
    """Adds each step's own share of a running total."""
    return totals.withColumn("own", F.col(total) - F.coalesce(F.lag(total).over(W.partitionBy(by).orderBy(order)), F.lit(0)))


def partition(traces: DataFrame, verdict: str = "verdict") -> DataFrame:
    """Adds part: T_pass or T_fail."""
    return traces.withColumn("part", F.when(F.col(verdict) == "pass", "T_pass").otherwise("T_fail"))


def regressions(old: DataFrame, new: DataFrame, id: str, ok: str = "ok", by: str | None = None, most: int = 2) -> DataFrame:
    """(by, regressions, accepted): rows right before and wrong now, and whether they are few enough."""
    both = old.where(ok).select(id).join(new.where(~F.col(ok)), id)
    keys = new.select(by).distinct() if by else new.sparkSession.range(1).select(F.lit("all").alias("checkpoint"))
    by = by or "checkpoint"
    counted = (both if by in both.columns else both.withColumn(by, F.lit("all"))).groupBy(by).agg(F.count("*").alias("regressions"))
    return keys.join(counted, by, "left").select(by, F.coalesce("regressions", F.lit(0)).alias("regressions")).withColumn("accepted", F.col("regressions") <= most)


def checkpoint_gate(old: DataFrame, new: DataFrame, id: str, checkpoint: str = "checkpoint", ok: str = "ok", most: int = 2) -> DataFrame:
    """One row: the worst count of regressions against any earlier checkpoint's right rows (checkpoint, id, ok), and whether all are few enough."""
    lost = new.where(~F.col(ok)).select(id)
    counts = old.select(checkpoint).distinct().join(old.where(ok).select(checkpoint, id).join(lost, id).groupBy(checkpoint).agg(F.count("*").alias("n")), checkpoint, "left")
    return counts.agg(F.count("*").alias("checkpoints"), F.coalesce(F.max(F.coalesce("n", F.lit(0))), F.lit(0)).alias("worst")).withColumn("accepted", F.col("worst") <= most)


def calibration(rows: DataFrame, confidence: str, right: Column, bins: int = 10, weight: float = 0.7) -> DataFrame:
    """(bin, n, accuracy, confidence, calibrated): calibrated = w * accuracy + (1 - w) * confidence."""
    bin_ = F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1)).cast("int")
    got = rows.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.avg(right.cast("double")).alias("accuracy"), F.avg(confidence).alias("confidence"))
    return got.withColumn("calibrated", weight * F.col("accuracy") + (1 - weight) * F.col("confidence"))


def replay(rows: DataFrame, order: str, by: str, fraction: float = 0.15, seed: int = 42) -> DataFrame:
    """The first ceil(fraction * n) rows of every group in seeded order: a buffer that covers all groups."""
    counted = rows.withColumn("_n", F.count("*").over(W.partitionBy(by)))
    rank = F.row_number().over(W.partitionBy(by).orderBy(T.seeded(F.col(order), seed), order))
    return counted.withColumn("_rn", rank).where(F.col("_rn") <= F.ceil(F.lit(fraction) * F.col("_n"))).drop("_rn", "_n")


def systematic(probes: DataFrame, by: str, failed: Column) -> DataFrame:
    """Categories of which more than half of the probes fail."""
    return probes.groupBy(by).agg(F.count("*").alias("probes"), F.avg(failed.cast("double")).alias("fail_rate")).withColumn("systematic", F.col("fail_rate") > 0.5)


def trainable(rows: DataFrame, label: str = "label", origin: str = "origin", ratio: int = 3) -> DataFrame:
    """One row: counts, and whether a set has hard rows and no label over `ratio` times another."""
    per = rows.groupBy(label).agg(F.count("*").alias("n"), F.count_if(F.col(origin) != "gold").alias("hard"))
    return per.agg(F.max("n").alias("largest"), F.min("n").alias("smallest"), F.sum("hard").alias("hard")).withColumn("accepted", (F.col("hard") > 0) & (F.col("largest") <= ratio * F.col("smallest")))


def best_candidate(candidates: DataFrame, by: str, most: int = 2) -> DataFrame:
    """Each group's best score among candidates with few enough regressions (the least id of equals)."""
    return candidates.where(F.col("regressions") <= most).groupBy(by).agg(F.max_by(F.struct("candidate", "score"), F.struct(F.col("score"), -F.col("candidate"))).alias("x")).select(by, F.col("x.candidate").alias("candidate"), F.col("x.score").alias("score"))


# Shares of a composition, least and most, in percent.
SHARES = {"gold": (40, 60), "hard": (25, 35), "replay": (10, 20)}


def composition_check(rows: DataFrame, origin: str = "origin") -> DataFrame:
    """(origin, n, percent, fits): each part's share of a set, and whether it is within its bounds; a part without rows has 0."""
    parts = rows.sparkSession.createDataFrame([(k, float(a), float(b)) for k, (a, b) in SHARES.items()], "origin string, low double, high double")
    counts = rows.groupBy(F.col(origin).alias("origin")).agg(F.count("*").alias("n"))
    total = counts.agg(F.greatest(F.sum("n"), F.lit(1)).alias("total"))
    got = F.broadcast(parts).join(counts, "origin", "left").crossJoin(F.broadcast(total)).select("origin", F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) * 100 / F.coalesce("total", F.lit(1))).alias("percent"), "low", "high")
    return got.select("origin", "n", "percent", F.col("percent").between(F.col("low"), F.col("high")).alias("fits"))


#: A production trace as it is logged, with the judge's configuration that made its verdict.
TRACE = "trace_id bigint, ts timestamp, input string, prediction string, corrected_output string, verdict string, judge_reasoning string, judge_metadata struct<model:string,prompt_template:string,criteria:string>"


def trace_table(rows: DataFrame, model: str, template: str, criteria: str) -> DataFrame:
    """Traces with a verdict (right if prediction and corrected output are equal) and the judge's configuration, so that verdicts can be made again."""
    same = F.col("prediction").eqNullSafe(F.col("corrected_output"))
    judge = F.struct(F.lit(model).alias("model"), F.lit(template).alias("prompt_template"), F.lit(criteria).alias("criteria"))
    why = F.when(same, "equal").otherwise(F.concat(F.lit("expected "), F.coalesce("corrected_output", F.lit("nothing"))))
    return rows.select("trace_id", F.col("ts").cast("timestamp").alias("ts"), "input", "prediction", "corrected_output", F.when(same, "pass").otherwise("fail").alias("verdict"), why.alias("judge_reasoning"), judge.alias("judge_metadata"))


def query_traces(sql: str, **tables: DataFrame) -> DataFrame:
    """A query over tables given by name, e.g. query_traces("SELECT … FROM {traces}", traces=df): nothing is registered in the session."""
    session = next(iter(tables.values())).sparkSession
    return session.sql(sql, **tables)


def failure_categories(failed: DataFrame, category: str, external: str) -> DataFrame:
    """(category, n, external_n, kind): a category of which most failures lie outside the model is external, else fixable."""
    got = failed.groupBy(category).agg(F.count("*").alias("n"), F.count_if(F.col(external)).alias("external_n"))
    return got.withColumn("kind", F.when(2 * F.col("external_n") > F.col("n"), "external").otherwise("fixable"))


def entity_type_balance(rows: DataFrame, order: str, entities: str = "entities", ratio: int = 3) -> DataFrame:
    """(order, place, text, type): spans in order, of each type at most `ratio` times the rarest type's count."""
    spans = rows.select(order, F.posexplode(entities).alias("place", "s")).select(order, "place", "s.text", "s.type")
    least = spans.groupBy("type").agg(F.count("*").alias("n")).agg(F.greatest(F.min("n"), F.lit(1)).alias("least"))
    ranked = spans.withColumn("_rn", F.row_number().over(W.partitionBy("type").orderBy(order, "place")))
    return ranked.crossJoin(F.broadcast(least)).where(F.col("_rn") <= ratio * F.col("least")).drop("_rn", "least")


def similar_to(corrected: DataFrame, rows: DataFrame, id: str, text: str = "text", least: float = 0.5) -> DataFrame:
    """(id, corrected_id, cosine): rows whose TF-IDF vector is that close to a corrected row's, for corrections to be carried over.

    Corrected rows are a stated query set.  idf = ln((1 + n) / (1 + df)) + 1; see `tfidf`.
    """
    got = tfidf.cosines(corrected, rows, id, text, least)
    return got.select(F.col("id").alias(id), F.col("q").alias("corrected_id"), "cosine")


def surface_patterns(rows: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """(label, patterns): different word-shape signatures of texts; a word's shape has its case and whether it has digits."""
    head = F.slice(F.split(F.coalesce(text, F.lit("")), " "), 1, 4)
    shape = lambda w: F.when(F.regexp_like(w, F.lit("[0-9]")), "d").when(F.regexp_like(w, F.lit("^[A-Z]+$")), "U").when(F.regexp_like(w, F.lit("^[A-Z]")), "C").otherwise("l")
    return rows.select(label, F.array_join(F.transform(head, shape), "").alias("sig")).groupBy(label).agg(F.count_distinct("sig").alias("patterns"))


def nearest_other(vectors: DataFrame, id: str, vector: str, label: str, queries: DataFrame) -> DataFrame:
    """Of each query vector, the most similar vector of another label: (id, other, cosine).  Queries are a small, stated set."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda z, x: z + x)
    q = queries.select(F.col(id).alias("q"), F.col(vector).alias("qv"), F.col(label).alias("ql"))
    pairs = vectors.join(q, F.col(label) != F.col("ql"))
    cos = dot(F.col(vector), F.col("qv")) / F.sqrt(dot(F.col(vector), F.col(vector)) * dot(F.col("qv"), F.col("qv")))
    return pairs.select("q", F.struct(cos.alias("cosine"), (-F.col(id)).alias("o")).alias("x")).groupBy("q").agg(F.max("x").alias("x")).select(F.col("q").alias(id), (-F.col("x.o")).alias("other"), F.col("x.cosine").alias("cosine"))

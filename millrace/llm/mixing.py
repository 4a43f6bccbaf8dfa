"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target (words): the weights' shares of the budget, none above
`max_epochs` times the source's size, the excess reshared by weight (water-filling, in
closed form over the sources' caps).  A source takes whole epochs first; the fraction
left is a weighted sample without replacement: a document's key is exponential,
-ln(u)/quality with u drawn from a seeded hash of its id, documents are ordered by key
within the source, and sizes are prefix-summed up to the budget, to the nearer side.

No source is sorted whole.  Keys fall into fine buckets; sizes are summed per (source,
bucket) with partial aggregation, bucket sums are prefix-summed, and only the documents
of the one bucket in which a source's budget ends are sorted.  The result is a
threshold per source, joined to the documents, so texts are never shuffled: the table
of sources is broadcast while it has at most `BROADCAST_SOURCES` rows, else joined by
key.

Defined cases.  Null text: size 0.  A null source is a source of its own, last in
order.  Rows of one source with equal ids (repeated rows, null ids) share a key and are
taken or left together.  Empty table: empty result.  Size-0 documents take 0 words.  An
input column named like an added column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.llm import scratch

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
BROADCAST_SOURCES = 100_000
#: Key buckets per unit of key.
GRAIN = 16384
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#$%&*!|<>{}[]=+_~^@0123456789"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def quality_of(text: Column) -> Column:
    """Share of a text's characters that are neither symbols nor digits, 0.05 at least; 1 for an empty text."""
    n = F.length(text)
    return F.when(F.coalesce(n, F.lit(0)) == 0, 1.0).otherwise(F.greatest(F.lit(0.05), F.length(F.translate(text, SYMBOLS, "")).cast("double") / n))


def key_of(id: Column, quality: Column, seed: str = SEED) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id.cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / quality


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: int | None = None) -> DataFrame:
    """(source, source_size) to (source, source_size, target); one row per source, so one task."""
    everything = W.partitionBy(F.lit(0))
    ranked = sizes.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    total = F.sum("source_size").over(everything) if budget is None else F.lit(int(budget))
    ranked = ranked.withColumns({"w": w, "cap": F.col("source_size") * max_epochs, "total": total})
    by_cap = everything.orderBy(F.col("cap") / F.col("w"), "rank")
    ranked = ranked.withColumns({
        "k": F.row_number().over(by_cap),
        "below": F.coalesce(F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "above": F.sum("w").over(by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)),
    })
    ranked = ranked.withColumn("level", (F.col("total") - F.col("below")).cast("double") / F.col("above"))
    free = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("k", "level"))
    ranked = ranked.withColumn("first", F.min(free).over(everything))
    target = F.when(F.col("k") >= F.col("first.k"), F.col("first.level") * F.col("w")).otherwise(F.col("cap").cast("double"))
    return ranked.select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: int | None = None, seed: str = SEED, quality=quality_of, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with size, source_size, target and taken (words taken, repeats counted).

    Sizes and keys need the texts.  If the text is not kept, these are written with the kept
    columns and the texts are read once, else twice.
    """
    spark = docs.sparkSession
    names = [f"__k{k}" for k in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    base = docs.toDF(*names).withColumns({"__source": F.col(of[source]).cast("string"), "__size": size_of(F.col(of[text])), "__key": key_of(F.col(of[id]), quality(F.col(of[text])), seed)})
    base = base.withColumn("__bucket", F.least(F.floor(F.col("__key") * GRAIN), F.lit(1 << 40)).cast("bigint"))
    kept = list(docs.columns) if keep is None else keep
    numbers = [F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__key").alias("key"), F.col("__bucket").alias("bucket")]
    if text in kept:
        thin = scratch.table(base.select(*numbers), "mix")
    else:
        base = scratch.table(base.select(*[of[c] for c in kept], "__source", "__size", "__key", "__bucket"), "mix")
        thin = base.select(*numbers)
    goal = scratch.table(targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs, budget), "targets")
    small = goal.count() <= BROADCAST_SOURCES
    side = F.broadcast if small else lambda x: x
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    goal = goal.select("source", "source_size", "target", epochs.alias("epochs"))
    goal = goal.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))

    sums = thin.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    order = W.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("n").over(order))
    g = goal.withColumnRenamed("source", "s")
    ends = sums.join(side(g.select("s", "left")), sums.source.eqNullSafe(g.s)).where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
    ends = ends.select(F.col("s"), F.col("bucket").alias("end_bucket"), (F.col("upto") - F.col("n")).alias("before"), "left")
    last = thin.join(side(ends), thin.source.eqNullSafe(ends.s) & (thin.bucket == ends.end_bucket))
    groups = last.groupBy("source", "end_bucket", "key").agg(F.sum("size").alias("n"), F.first("before").alias("before"), F.first("left").alias("left"))
    upto = F.sum("n").over(W.partitionBy("source").orderBy("key")) + F.col("before")
    cut = groups.withColumn("upto", upto).groupBy("source", "end_bucket").agg(F.max(F.when(2 * F.col("upto") - F.col("n") <= 2 * F.col("left"), F.col("key"))).alias("cut"))
    cut = cut.withColumnRenamed("source", "c")
    plan = scratch.table(g.join(cut, g.s.eqNullSafe(cut.c), "left").select("s", "source_size", "target", "epochs", "end_bucket", "cut"), "plan")
    chosen = (F.col("__bucket") < F.col("end_bucket")) | ((F.col("__bucket") == F.col("end_bucket")) & (F.col("__key") <= F.col("cut")))
    taken = F.col("__size") * (F.col("epochs") + F.when(chosen, 1).otherwise(0))
    got = base.join(side(plan), base["__source"].eqNullSafe(plan.s))
    new = {"size": F.col("__size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": taken.cast("bigint")}
    return got.select(*[F.col(of[c]).alias(c) for c in kept if c not in new], *[x.alias(c) for c, x in new.items()])


#: DuckDB: the same draw over `docs` (doc_id, text, source).
SQL = rf"""
, base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / CASE WHEN coalesce(length(text), 0) = 0 THEN 1.0 ELSE greatest(0.05, length(translate(text, '{SYMBOLS}', ''))::DOUBLE / length(text)) END AS key
  FROM docs),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
ranked AS (SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank, 3 * source_size AS cap, sum(source_size) OVER ()::BIGINT AS total FROM src),
lev AS (SELECT *, row_number() OVER o AS k,
    (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM ranked WINDOW o AS (ORDER BY cap::DOUBLE / w, rank)),
free AS (SELECT k AS k0, level AS level0 FROM lev WHERE level * w <= cap ORDER BY k LIMIT 1),
goal AS (SELECT source, source_size, CASE WHEN k >= k0 THEN level0 * w ELSE cap::DOUBLE END AS target FROM lev, free),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM goal),
drawn AS (SELECT base.*, source_size, target, epochs, target - epochs * source_size AS left_over,
    sum(size) OVER (PARTITION BY base.source ORDER BY key RANGE UNBOUNDED PRECEDING) AS upto, sum(size) OVER (PARTITION BY base.source, key) AS n
  FROM base JOIN plan ON base.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN 2 * upto - n <= 2 * left_over THEN 1 ELSE 0 END))::BIGINT AS taken FROM drawn
"""

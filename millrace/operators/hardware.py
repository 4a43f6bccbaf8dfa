"""The model catalogue, device limits and training configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# Model, INT4 size (MB), tier, tokens a second on three chips, peak memory (MB).
POOL = [
    ("Qwen/Qwen3-0.6B", 397, 1, 8.0, 15.0, 50.0, 500),
    ("Qwen/Qwen3.5-0.8B", 500, 1, 7.0, 13.0, 45.0, 620),
    ("openbmb/MiniCPM4-0.5B", 300, 1, 10.0, 18.0, 60.0, 380),
    ("openbmb/MiniCPM5-1B", 500, 1, 8.0, 16.0, 55.0, 620),
    ("google/gemma-3-1b-it", 529, 1, 9.0, 17.0, 70.0, 660),
    ("meta-llama/Llama-3.2-1B", 808, 1, 6.0, 12.0, 40.0, 980),
    ("HuggingFaceTB/SmolLM2-1.7B-Instruct", 1060, 2, 4.0, 8.0, 30.0, 1280),
    ("Qwen/Qwen3-1.7B", 1190, 2, 4.0, 8.0, 30.0, 1430),
    ("Qwen/Qwen3.5-2B", 1200, 2, 3.5, 7.0, 28.0, 1440),
    ("deepseek-ai/DeepSeek-R1-Distill-Qwen-1.5B", 1290, 2, 3.0, 6.0, 25.0, 1550),
]
POOL_SCHEMA = "pos int, model_id string, int4_size_mb int, tier int, tok_s_660 double, tok_s_778g double, tok_s_8gen3 double, peak_memory_mb int"

RANKS = (4, 8, 16, 32, 64)


def pool(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *row) for k, row in enumerate(POOL)], POOL_SCHEMA)


def feasible(models: DataFrame, storage_mb: int, memory_mb: int) -> DataFrame:
    """Models within the limits, with their rank by tier and size (ties in catalogue order)."""
    rank = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("tier", "int4_size_mb", "pos"))
    return models.where((F.col("int4_size_mb") <= storage_mb) & (F.col("peak_memory_mb") <= memory_mb)).withColumn("rank", rank)


def check(models: DataFrame, storage_mb: Column, memory_mb: Column, ttft_ms: Column, chip: Column) -> DataFrame:
    """Whether each model meets each limit; chips that aren't known count as the middle one; power always passes."""
    tok = F.when(chip == "snapdragon_660", F.col("tok_s_660")).when(chip == "snapdragon_8gen3", F.col("tok_s_8gen3")).otherwise(F.col("tok_s_778g"))
    got = models.withColumn("tok_s", tok).withColumn("_ttft", 1000 / F.greatest("tok_s", F.lit(0.1)))
    return got.select("model_id", (F.col("int4_size_mb") <= storage_mb).alias("storage_pass"), (F.col("peak_memory_mb") <= memory_mb).alias("memory_pass"), "tok_s", F.bround("_ttft").cast("bigint").alias("ttft_ms"), (F.col("_ttft") <= ttft_ms).alias("latency_pass"), F.lit(True).alias("power_pass"))


def profile(ids: DataFrame, models: DataFrame) -> DataFrame:
    """What the catalogue says of each model id; nulls and a note for unknown ones."""
    known = models.drop("pos")
    got = ids.join(F.broadcast(known), "model_id", "left")
    return got.withColumns({"phase": F.lit("theoretical"), "note": F.when(F.col("tier").isNull(), "not in the catalogue")})


def next_model(ranked: DataFrame) -> DataFrame:
    """(model_id, next_model): the one after it in feasible order; null: stop."""
    return ranked.select("model_id", F.lead("model_id").over(W.partitionBy(F.lit(0)).orderBy("rank")).alias("next_model"))


def nearest_rank(rank: Column) -> Column:
    """Nearest valid LoRA rank, the smaller of equals; null stays (full fine-tuning)."""
    best = F.array_min(F.transform(F.array(*[F.lit(r) for r in RANKS]), lambda r: F.struct(F.abs(r - rank).alias("d"), r.alias("r"))))
    return F.when(rank.isNotNull(), best.r)


def valid_config(rank: Column, rate: Column) -> Column:
    return (rank.isNull() | rank.isin(*RANKS)) & (rate > 0) & (rate < 1)


# The two configurations that are trained when nothing else is proposed.
DEFAULT_CONFIGS = [
    ("A: LoRA r=8", 8, 2e-4, 3, 8),
    ("B: full_ft", None, 1e-4, 5, 4),
]


def default_configs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_CONFIGS, "label string, lora_rank int, learning_rate double, nr_epochs int, batch_size int")


def config_label(config: Column, rank: Column, rate: Column, epochs: Column) -> Column:
    """Label of a proposed configuration, e.g. 'A: LLM-hp r=8 lr=2e-04 ep=3'."""
    kind = F.when(config == "A", "LLM-hp").otherwise("LoRA")
    return F.concat(config, F.lit(": "), kind, F.lit(" r="), F.coalesce(rank.cast("string"), F.lit("None")), F.lit(" lr="), F.format_string("%.0e", rate), F.lit(" ep="), epochs.cast("string"))


def pass_lines(checked: DataFrame, storage_mb: Column, memory_mb: Column, ttft_ms: Column, chip: Column) -> Column:
    """Markdown of a model's check against the limits; its columns come from `check`, sizes from the catalogue."""
    said = lambda c: F.when(F.col(c), "PASS").otherwise("FAIL")
    s = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.concat_ws("\n",
        F.concat(F.lit("- Storage: "), s("int4_size_mb"), F.lit("MB vs S_max="), s(storage_mb), F.lit("MB — "), said("storage_pass")),
        F.concat(F.lit("- Memory: "), s("peak_memory_mb"), F.lit("MB vs M_max="), s(memory_mb), F.lit("MB — "), said("memory_pass")),
        F.concat(F.lit("- Latency: "), s("ttft_ms"), F.lit("ms vs L_max="), s(ttft_ms), F.lit("ms ("), s("tok_s"), F.lit(" tok/s on "), chip, F.lit(") — "), said("latency_pass")),
        F.concat(F.lit("- Power: not measured — "), said("power_pass")))


def configs(params: DataFrame) -> DataFrame:
    """Two configurations for each row of proposed (lora_rank, learning_rate, nr_epochs, batch_size)."""
    rank, rate = nearest_rank(F.col("lora_rank")), F.coalesce("learning_rate", F.lit(2e-4))
    epochs, batch = F.greatest(F.coalesce("nr_epochs", F.lit(3)), F.lit(1)), F.coalesce("batch_size", F.lit(8))
    row = lambda name, r, lr, ep: F.struct(F.lit(name).alias("config"), r.cast("int").alias("lora_rank"), lr.alias("learning_rate"), ep.cast("int").alias("nr_epochs"), batch.cast("int").alias("batch_size"))
    twice = F.when((2 * rank).isin(*RANKS), 2 * rank).otherwise(rank)
    b = F.when(rank.isNull(), row("B", F.lit(16), rate * 2, epochs)).otherwise(row("B", twice, rate / 2, F.greatest(epochs - 1, F.lit(1))))
    keep = [c for c in params.columns if c not in ("lora_rank", "learning_rate", "nr_epochs", "batch_size")]
    return params.select(*keep, F.explode(F.array(row("A", rank, rate, epochs), b)).alias("x")).select(*keep, "x.*")

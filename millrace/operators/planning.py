"""Task plans and device limits, read from a planner's replies with defaults for what they lack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import text as T
from millrace.operators import evalset, hardware

# What a plan and a device count as where a reply doesn't say.
STOP = 0.96
LIMITS = {"storage_mb": 1500, "memory_mb": 3000, "latency_ttft_ms": 2000, "power_watts": 5.0}
CHIPS = ("snapdragon_660", "snapdragon_778g", "snapdragon_8gen3")
CHIP = "snapdragon_778g"

_PLAN = "task_type string, task_name string, labels array<string>, exa_queries map<string,string>, benchmark string, stop_threshold string"
_DEVICE = "device string, storage_budget_mb string, usable_ram_mb string, latency_ttft_ms string, power_watts string, reference_chip string"


def valid_task(task: Column) -> Column:
    return F.coalesce(task.isin(*evalset.TASKS), F.lit(False))


def plan(raw: Column, strict: bool = False) -> Column:
    """A reply's plan (task_type, task_name, labels, queries, benchmark, stop_threshold).

    A reply without readable JSON or with an unknown task type gives null, or, if strict,
    ends the query with an error.
    """
    read = T.json_object(raw, _PLAN)
    whole = F.struct(
        read.task_type.alias("task_type"), F.coalesce(read.task_name, F.lit("task")).alias("task_name"), F.coalesce(read.labels, F.array().cast("array<string>")).alias("labels"),
        F.coalesce(read.exa_queries, F.create_map().cast("map<string,string>")).alias("queries"), read.benchmark.alias("benchmark"), F.coalesce(read.stop_threshold.try_cast("double"), F.lit(STOP)).alias("stop_threshold"),
    )
    fail = F.raise_error(F.concat(F.lit("no valid plan in: "), F.substring(F.coalesce(raw, F.lit("")), 1, 200)))
    return F.when(valid_task(read.task_type), whole).otherwise(fail) if strict else F.when(valid_task(read.task_type), whole)


def limits(raw: Column) -> Column:
    """A reply's device limits (storage_mb, memory_mb, latency_ttft_ms, power_watts, target_chip), with defaults; whole numbers are cut, chips that aren't known are the middle one."""
    read = T.json_object(raw, _DEVICE)
    whole = lambda c, name: F.coalesce(F.when(c.try_cast("double") >= 0, F.floor(c.try_cast("double"))).otherwise(F.ceil(c.try_cast("double"))).cast("int"), F.lit(LIMITS[name])).alias(name)
    return F.struct(
        whole(read.storage_budget_mb, "storage_mb"), whole(read.usable_ram_mb, "memory_mb"), whole(read.latency_ttft_ms, "latency_ttft_ms"),
        F.coalesce(read.power_watts.try_cast("double"), F.lit(LIMITS["power_watts"])).alias("power_watts"), F.when(read.reference_chip.isin(*CHIPS), read.reference_chip).otherwise(CHIP).alias("target_chip"),
    )


def snippets(hits: DataFrame, by: str, order: str, n: int = 3) -> DataFrame:
    """(by, snippets): '- title: text' of the first n hits of each group, a line each."""
    first = hits.withColumn("_rn", F.row_number().over(W.partitionBy(by).orderBy(order))).where(F.col("_rn") <= n)
    line = F.concat(F.lit("- "), F.substring(F.coalesce("title", F.lit("")), 1, 80), F.lit(": "), F.substring(F.coalesce("text", F.lit("")), 1, 300))
    return first.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", line.alias("line")))), lambda x: x.line), "\n").alias("snippets"))


def start_model(models: DataFrame, devices: DataFrame, by: str, forced: str | None = None) -> DataFrame:
    """(by, model_id): the first feasible model of each device (storage_mb, memory_mb), or the forced one if it is feasible; null: none is."""
    fits = _fitting(devices, models, by)
    if forced is not None:
        fits = fits.where(F.col("model_id") == forced)
    first = fits.groupBy(by).agg(F.min_by("model_id", F.struct("tier", "int4_size_mb", "pos")).alias("model_id"))
    return devices.select(by).join(first, by, "left")


def _fitting(devices: DataFrame, models: DataFrame, by: str) -> DataFrame:
    fits = (F.col("int4_size_mb") <= F.col("storage_mb")) & (F.col("peak_memory_mb") <= F.col("memory_mb"))
    return devices.select(by, "storage_mb", "memory_mb").join(F.broadcast(models), fits).drop("storage_mb", "memory_mb")


def escalate(devices: DataFrame, models: DataFrame, by: str, current: str = "model_id") -> DataFrame:
    """(by, next_model, next_action, …): the model after the current one in the device's feasible order.

    With a next model the trajectory starts anew (no scores, iteration 0, best score 0)
    and curation follows; without one, or if the current model isn't feasible itself,
    the run ends.
    """
    order = W.partitionBy(by).orderBy("tier", "int4_size_mb", "pos")
    after = _fitting(devices, models, by).withColumn("next_model", F.lead("model_id").over(order)).select(by, F.col("model_id").alias(current), "next_model")
    got = devices.select(by, current).join(after, [by, current], "left")
    on = F.col("next_model").isNotNull()
    return got.select(by, "next_model", F.when(on, "curate").otherwise("terminate").alias("next_action"), F.when(on, 0).alias("iteration"), F.when(on, 0.0).alias("best_score"), F.when(on, 0).alias("no_improve"))


def model_pool(devices: DataFrame) -> DataFrame:
    return hardware.pool(devices.sparkSession)

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import hardware, lineage, traces
from millrace.sources import files
from millrace.streaming import costs


@pytest.mark.parametrize("score,action", [(0.75, "data_rebuild"), (0.87, "hyperparameter"), (0.97, "surgical"), (0.80, "hyperparameter"), (0.95, "surgical")])
def test_policy(spark, score, action):
    assert spark.range(1).select(lineage.policy(F.lit(score))).first()[0] == action


@pytest.mark.parametrize("scores,back", [([0.85, 0.82], True), ([0.82, 0.87], False), ([0.75], False), ([], False)])
def test_should_rollback(spark, scores, back):
    assert spark.createDataFrame([(scores,)], "s array<double>").select(lineage.should_rollback(F.col("s"))).first()[0] is back


def test_one_regression_counts_twice(spark):
    rows = spark.createDataFrame([("r", i, s) for i, s in enumerate([0.8, 0.7, 0.75, 0.9])], "run string, seq int, score double")
    got = lineage.rollback_fold(rows).first()
    assert got.accepted == [0.8, 0.9] and got.rollbacks == 2 and got.no_improve == 0
    assert lineage.rollback_fold(rows.where("seq < 2")).first().no_improve == 2


def test_backpropagation_on_a_chain(spark):
    n = spark.createDataFrame([(1, None, 1.0), (2, 1, 2.0), (3, 2, 3.0), (4, 3, 4.0), (5, 4, 5.0)], "id int, parent_id int, score double")
    got = {r.id: (r.visits, r.mean_score) for r in lineage.backpropagate(n).collect()}
    assert got == {1: (5, 3.0), 2: (4, 3.5), 3: (3, 4.0), 4: (2, 4.5), 5: (1, 5.0)}


def test_compaction_keeps_short_logs(spark):
    entry = "## Iteration {0} — x\n- f(π_{0}): 0.5000\n- Score band: low\n- Next intervention: go\n- Hypothesis: why\n- Model: m\n"
    for n in (2, 3, 5):
        log = "# Log\n" + "".join(entry.format(i) for i in range(n))
        got = spark.range(1).select(lineage.compact(F.lit(log))).first()[0]
        assert (got == log) == (n <= 3)
    assert "- Iter 0: f(π)=0.5000, band=low, intervention=go, model=m — why\n- Iter 1" in got and got.count("## Iteration") == 3
    assert spark.range(1).select(lineage.summary_line(F.lit("none"))).first()[0] == "- Iter ?: f(π)=?, band=?, intervention=?, model=?"


@pytest.mark.parametrize("storage,memory,n", [(500, 1200, 4), (1600, 2000, 10), (100, 200, 0)])
def test_pool(spark, storage, memory, n):
    got = hardware.feasible(hardware.pool(spark), storage, memory).orderBy("rank").collect()
    assert len(got) == n and [(r.tier, r.int4_size_mb) for r in got] == sorted((r.tier, r.int4_size_mb) for r in got)


@pytest.mark.parametrize("rank,near", [(6, 4), (64, 64), (None, None), (100, 64), (13, 16)])
def test_nearest_rank(spark, rank, near):
    assert spark.range(1).select(hardware.nearest_rank(F.lit(rank).cast("int"))).first()[0] == near


def test_configs(spark):
    rows = spark.createDataFrame([(0, 64, 0.01, 1, 8), (1, None, 0.01, 3, None)], "k int, lora_rank int, learning_rate double, nr_epochs int, batch_size int")
    got = {(r.k, r.config): (r.lora_rank, r.learning_rate, r.nr_epochs, r.batch_size) for r in hardware.configs(rows).collect()}
    assert got == {(0, "A"): (64, 0.01, 1, 8), (0, "B"): (64, 0.005, 1, 8), (1, "A"): (None, 0.01, 3, 8), (1, "B"): (16, 0.02, 3, 8)}


def test_ledger_ignores_null_tokens(spark):
    rows = spark.createDataFrame([("llm", 1_000_000, None, 1), ("llm", None, 100_000, 1), ("search", None, None, 2)], "kind string, input_tokens long, output_tokens long, n int")
    got = traces.ledger(rows).first()
    assert (got.llm_calls, got.searches, got.usd) == (2, 2, 4.51)


def test_regressions_of_nothing(spark):
    old = spark.createDataFrame([(1, True), (2, True), (3, True)], "id int, ok boolean")
    assert traces.regressions(old, old, "id").first().regressions == 0
    new = old.withColumn("ok", F.lit(False))
    got = traces.regressions(old, new, "id").first()
    assert (got.regressions, got.accepted) == (3, False)


def test_files(spark, tmp_path):
    (tmp_path / "x.tsv").write_text('ham\tHe said "hi\nspam\tFREE\tNOW\nbroken line\n\n')
    assert sorted(files.labelled_tsv(spark, str(tmp_path / "x.tsv")).collect()) == [("ham", 'He said "hi'), ("spam", "FREE\tNOW")]
    rows = spark.createDataFrame([("a", "x"), ("b", None)], "text string, label string")
    where = files.write_jsonl(rows, str(tmp_path / "set"), 1)
    assert sorted(files.read_jsonl(spark, where).select("text", "label").collect()) == [("a", "x"), ("b", None)]
    log = str(tmp_path / "log")
    assert files.read_log(spark, log, "text string, label string").count() == 0
    files.append_log(rows, log)
    files.append_log(rows, log)
    assert files.read_log(spark, log, "text string, label string").count() == 4


def test_cost_stream_equals_batch(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(day + datetime.timedelta(hours=7 * i), i, 2 * i, i % 2) for i in range(40)], "ts timestamp, input_tokens long, output_tokens long, searches int")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = costs.cost_rollup(stream).writeStream.outputMode("complete").format("memory").queryName("cost_out").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("cost_out").collect()) == sorted(costs.cost_rollup(rows).collect())


def test_dedup_stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = spark.createDataFrame([("k", "a b c"), ("k", "C b a"), ("k", "z"), ("k", ""), ("k", ""), ("l", "a b c")], "key string, text string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = costs.surface_dedup(stream, "key").writeStream.outputMode("append").format("memory").queryName("dedup_out").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in spark.table("dedup_out").collect()) == [("k", ""), ("k", ""), ("k", "a b c"), ("k", "z"), ("l", "a b c")]

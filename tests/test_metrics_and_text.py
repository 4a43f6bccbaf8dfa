import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import metrics


@pytest.mark.parametrize("predicted,f1", [("ssnn", 1.0), ("nnnn", 0.0), ("snsn", 0.5)])
def test_binary_f1(spark, predicted, f1):
    rows = spark.createDataFrame([(g, p) for g, p in zip("ssnn", predicted, strict=True)], "label string, predicted string")
    assert metrics.binary_f1(rows, "s").first().f1 == pytest.approx(f1)


def test_entity_f1_counts_spans_once(spark):
    kind = "entities array<struct<text:string,type:string>>, predicted array<struct<text:string,type:string>>"
    rows = spark.createDataFrame([([("a", "P"), ("a", "P"), ("b", "Q")], [("a", "P"), ("b", "X")]), ([], [("c", "P")]), (None, None)], kind)
    got = metrics.entity_f1(rows).first()
    assert (got.tp, got.fp, got.fn) == (1, 2, 1) and got.f1 == pytest.approx(0.4)
    assert metrics.entity_failures(rows).count() == 2


def test_slices_without_rows_score_zero(spark):
    rows = spark.createDataFrame([("pos", "a", "a"), ("neg", "b", None)], "slice string, label string, predicted string")
    got = {r.slice: (r.n, r.accuracy) for r in metrics.slice_accuracy(rows, F.col("label") == F.col("predicted")).collect()}
    assert got == {"pos": (1, 1.0), "neg": (1, 0.0), "boundary": (0, 0.0)}


def test_headline(spark):
    two = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a")], "label string, predicted string")
    assert metrics.headline_f1(two).first().f1 == 0.0  # b is the rarer one
    three = spark.createDataFrame([("a", "a"), ("b", "b"), ("c", "z")], "label string, predicted string")
    assert metrics.headline_f1(three).first().f1 == pytest.approx(2 / 3)


def test_ranks_are_global(spark):
    rows = spark.range(0, 500, 3).withColumnRenamed("id", "pos").repartition(5)
    assert sorted((r.pos, r.rank) for r in metrics.ranks(rows, "pos").collect()) == [(3 * i, i + 1) for i in range(167)]


@pytest.mark.parametrize("raw,found", [
    ("CHAMPION", "ham"), (" Spam!", "spam"), ("none", T.UNKNOWN_LABEL), ("", T.UNKNOWN_LABEL), ("ham and spam", "ham"),
])
def test_label_extraction(spark, raw, found):
    assert spark.range(1).select(T.extract_label(F.lit(raw), F.array(F.lit("spam"), F.lit("ham")))).first()[0] == found


@pytest.mark.parametrize("raw,greedy,n", [
    ('x [{"text":"a","type":"P"}] y', False, 1), ('[{"text":"a"}]', False, 0), ("[broken", False, 0), ("", False, 0), ('[{"text":"a","type":"P"}] and [1]', False, 1), ('[["a"]]', False, 0), ('[{"text":"a","type":"P"},\n{"text":"b","type":"Q"}]', True, 2),
])
def test_spans(spark, raw, greedy, n):
    assert len(spark.range(1).select(T.spans_of(F.lit(raw), greedy)).first()[0]) == n


@pytest.mark.parametrize("raw,a", [('```json\n{"a": 1}\n```', 1), ('so: {"a": 2} ok', 2), ("nothing", None)])
def test_json_object(spark, raw, a):
    got = spark.range(1).select(T.json_object(F.lit(raw), "struct<a:int>").alias("x")).first().x
    assert (got.a if got else None) == a


@pytest.mark.parametrize("said,kind", [
    ("Spam filter", "classification"), ("text generation", "NER"), ("a research paper", "generation"), ("CoNLL tagging", "NER"), ("poetry", None),
])
def test_task_type(spark, said, kind):
    assert spark.range(1).select(T.task_type(F.lit(said))).first()[0] == kind


def test_pages(spark):
    from millrace.sources.files import documents_of

    rows = spark.createDataFrame([("h/a", None, "x" * 180), ("h/b", " T ", "x" * 179), ("h/list/c", "T", "x" * 300), ("h/d", "T", "\n" + "y\n" * 500), ("h/e", "T", None)], "url string, title string, text string")
    got = {r.url: r.text for r in documents_of(rows).collect()}
    assert set(got) == {"h/a", "h/d"} and got["h/a"] == ". " + "x" * 180 and len(got["h/d"]) == 700


def test_training_texts(spark):
    user, said, plain = T.training_text("NER", F.lit("t"), entities=F.array(F.struct(F.lit("a").alias("text"), F.lit("P").alias("type"))))
    got = spark.range(1).select(said.alias("s"), plain.alias("p")).first()
    assert json.loads(got.s) == [{"text": "a", "type": "P"}] and got.p.endswith("\n\nEntities: " + got.s)
    user, said, plain = T.training_text("generation", F.lit(None).cast("string"), F.lit("l"), prompt=F.lit("q"))
    assert spark.range(1).select(plain).first()[0] == "q\n\nAnswer: l"

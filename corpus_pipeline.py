"""From raw documents to a training mix: five stages, each on all that the one before kept.

Every stage's result is written as Parquet and read again as the next one's documents;
so a stage starts by dropping the tables that earlier stages of the same run needed on
their way, and no others.

Defined cases of all stages.  Columns beyond doc_id, text and source pass through whatever
they are called, also where an operator has a result of that name (only the last stage's
size, source_size, target and taken replace columns of those names).  Null and blank texts
are clean documents: they stay, with importance 0, nothing to cut, no near copies and no
benchmark window, until the mix takes 0 of their 0 words and leaves them out.  Repeated rows
and rows of equal or null ids: the quality stage judges them alike, line and near dedup
leave one of equal texts.  Texts of any length are read whole.  An empty table stays empty.
n_chars, if there is such a column, follows a cut text.
"""

from __future__ import annotations

import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, lines, mixing, quality, scratch

#: Which run a stage belongs to; stages called one by one are one run.
_run: ContextVar[str] = ContextVar("run", default="pipeline-")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stage(f):
    """A stage whose tables are its run's, and that starts without those of earlier ones; the documents' columns are hidden from the operator's own names."""
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        scratch.release(spark, keep=docs, of=_run.get())
        hidden = [c if c in ("doc_id", "text", "source", "n_chars") else f"__d{k}" for k, c in enumerate(docs.columns)]
        with scratch.owner(_run.get()):
            got = f(spark, docs.toDF(*hidden), sf_dir)
        back = dict(zip(hidden, docs.columns, strict=True))
        added = [c for c in got.columns if c not in back]
        return got.select(*[F.col(c).alias(back[c]) for c in hidden if back[c] not in added], *added)

    stage.__name__, stage.__doc__ = f.__name__, f.__doc__
    return stage


@_stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampler accepts."""
    return quality.classify(docs, _table(spark, sf_dir, "labels")).where("accepted").select(*docs.columns)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks of lines that came before; texts that were nothing else go. n_chars follows the text."""
    got = lines.dedup(docs).where((F.col("removed_chunks") == 0) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        got = got.withColumn("n_chars", F.when(F.col("removed_chunks") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return got.select(*docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


@_stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.remove(docs, _table(spark, sf_dir, "benchmark"))


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [("quality", quality_filter), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("mix", mixed)]

#: Line chunks and the classifier's hashed models can't be said in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    was = _run.set(f"run-{uuid.uuid4().hex}-")
    try:
        for k, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k + 1 < len(STAGES):
                with scratch.owner(_run.get()):
                    docs = scratch.table(docs, name)
        return docs
    finally:
        _run.reset(was)

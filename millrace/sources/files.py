"""Readers and writers of the datasets' file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import text as T

EXAMPLE = "text string, label string, prompt string, response string, answer string, entities array<struct<text:string,type:string>>"

# What is searched for a topic without a query of its own, by kind of search; the areas of papers and their queries.
DEFAULT_QUERY = "{label} example text"
PAPER_QUERY = "{label} research paper abstract"
AREAS = {
    "Computer Science": "transformer neural network deep learning research paper abstract",
    "Physics": "quantum field theory condensed matter physics research paper abstract",
    "Mathematics": "algebraic topology theorem proof mathematics research paper abstract",
    "Biology": "CRISPR gene expression molecular biology research paper abstract",
    "Economics": "macroeconomic policy inflation econometrics research paper abstract",
}
#: Labels or topics that are searched for, and hits of each.
MOST_LABELS, PER_LABEL, PER_AREA = 6, 16, 20
NO_HITS = "No results found."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(label, text) of lines 'label TAB text'; lines without a tab are left out, quotes mean nothing."""
    return tsv_rows(spark.read.text(path))


def tsv_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    parts = F.split(T.strip(F.col(value)), "\t", 2)
    return lines.where(F.size(parts) == 2).select(T.strip(parts[0]).alias("label"), parts[1].alias("text"))


def write_jsonl(rows: DataFrame, path: str, version: int) -> str:
    """One JSON object a line, in a folder of its own for each version."""
    where = f"{path}/version={version}"
    rows.write.json(where)
    return where


def read_jsonl(spark: SparkSession, path: str, schema: str = EXAMPLE) -> DataFrame:
    """Rows of JSON lines by a given schema; blank lines don't count."""
    return spark.read.schema(schema).json(path)


def hits(pages: DataFrame) -> DataFrame:
    """Search hits (page_id, url, title, text) of raw pages; text is at most 800 characters."""
    html = F.coalesce("html", F.lit(""))
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    body = html
    for tag in ("script", "style", "title"):
        body = F.regexp_replace(body, rf"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    body = F.regexp_replace(body, r"(?s)<[^>]*>", " ")
    return pages.select("page_id", "url", F.when(title == "", None).otherwise(title).alias("title"), F.substring(T.strip(F.regexp_replace(body, r"[ \t]+", " ")), 1, 800).alias("text"))


def documents_of(hits: DataFrame, least: int = 180, skip: tuple[str, ...] = T.SKIP_WEB, domain: str | None = None) -> DataFrame:
    """Hits worth keeping, as documents: the length counts before the title is put in front."""
    text = T.page_text(F.col("text"))
    keep = T.looks_useful(F.col("url"), text, least, skip)
    if domain:
        keep = keep & F.contains("url", F.lit(domain))
    return hits.where(keep).withColumn("text", T.page_document(F.col("title"), text)).drop("title")


def with_query(labels: DataFrame, queries: DataFrame, default: str = DEFAULT_QUERY) -> DataFrame:
    """(label, query): the planned query of each label, or the default one."""
    return labels.join(queries, "label", "left").select("label", F.coalesce("query", F.replace(F.lit(default), F.lit("{label}"), F.col("label"))).alias("query"))


def areas(spark: SparkSession) -> DataFrame:
    """(label, query) of the areas that papers are searched for."""
    return spark.createDataFrame(list(AREAS.items()), "label string, query string")


def planned(labels: DataFrame, queries: DataFrame, order: str, default: str = DEFAULT_QUERY, most: int = MOST_LABELS) -> DataFrame:
    """(label, query) of the first labels in their order."""
    return with_query(labels.orderBy(order).limit(most).select("label"), queries, default)


def acquired(found: DataFrame, plan: DataFrame, order: str, per_label: int = PER_LABEL, **how) -> DataFrame:
    """Labelled examples of search hits (label, url, title, text): of each planned label the first hits that are worth keeping.

    A label whose search found nothing has no rows; `how` is that of `documents_of`.  The
    test part is `evalset.split` with a third (0.3).
    """
    first = found.join(plan.select("label"), "label", "left_semi").withColumn("_rn", F.row_number().over(W.partitionBy("label").orderBy(order))).where(F.col("_rn") <= per_label).drop("_rn")
    return documents_of(first, **how).select(order, "text", "label")


def acquired_papers(found: DataFrame, plan: DataFrame, order: str, per_area: int = PER_AREA) -> DataFrame:
    return acquired(found, plan, order, per_area, least=200, skip=T.SKIP_PAPERS, domain="arxiv.org")


def search_report(hits: DataFrame, order: str, by: str, asked: DataFrame | None = None) -> DataFrame:
    """(by, report): hits as '**title**', address and 500 characters, in order, parted by '---'; groups `asked` for without hits say so."""
    if asked is not None:
        got = asked.select(by).distinct().join(search_report(hits, order, by), by, "left")
        return got.select(by, F.coalesce("report", F.lit(NO_HITS)).alias("report"))
    one = F.concat(F.lit("**"), F.coalesce("title", F.lit("")), F.lit("**\n"), F.col("url"), F.lit("\n"), F.substring("text", 1, 500))
    return hits.select(by, F.struct(F.col(order).alias("o"), one.alias("r")).alias("x")).groupBy(by).agg(F.array_sort(F.collect_list("x")).alias("xs")).select(by, F.array_join(F.transform("xs", lambda x: x.r), "\n---\n").alias("report"))


def evaluation_json(rows: DataFrame, task: str, order: str) -> DataFrame:
    """One row with an evaluation set as JSON: task, counts and slices (at most some hundred rows)."""
    item = F.struct(order, "text", "label")
    part = lambda s: F.array_sort(F.coalesce(F.collect_list(F.when(F.col("slice") == s, item)), F.array()))
    count = lambda s: F.count_if(F.col("slice") == s)
    counts = F.struct(count("pos").alias("pos"), count("neg").alias("neg"), count("boundary").alias("boundary"), F.count("*").alias("total"))
    return rows.agg(F.to_json(F.struct(F.lit(task).alias("task_type"), counts.alias("counts"), part("pos").alias("pos"), part("neg").alias("neg"), part("boundary").alias("boundary"))).alias("json"))


def write_artifacts(path: str, **tables: DataFrame) -> dict[str, str]:
    """A run's tables (dag, scores, cost, task_plan, device_research, …) as JSON lines, a folder for each."""
    written = {}
    for name, rows in tables.items():
        written[name] = f"{path}/{name}.json"
        rows.write.mode("overwrite").json(written[name])
    return written


def append_log(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The iteration log; empty if nothing has been written yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

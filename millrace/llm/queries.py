"""The queries of this subpackage, one opN_<name> for each operator, and their DuckDB SQL.

Every query applies its operator with production parameters to its whole table and
derives the digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, decontaminate, embeddings, jaccard, lines, mixing, ngram_lm, quality, substrings, suffixes

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort("items"), ",")
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_ALNUM = r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"
OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({LOWER.format('text')}, '{_ALNUM}'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format('text')}, '{_ALNUM}') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT n FROM g),
t AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths WHERE len(w) >= n)),
m AS (SELECT t.r, t.n, t.i, g.item_id FROM t JOIN g USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY encode(s)) AS s FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = "WITH docs AS (SELECT doc_id, text, source FROM documents)" + mixing.SQL


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(k).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text")) for k, role in enumerate(("user", "assistant"))])).alias("x")).select("x.*")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    got = chat.format_conversations(rows)
    got = got.withColumns({"turns": chat.parse(F.col("formatted")), "learned": chat.masked_text(F.col("formatted"), F.col("loss_mask"))})
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return got.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars")
    )


OP3_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (SELECT *, lag(role) OVER o AS before, row_number() OVER o AS k,
    length(replace(replace(role, '\', '\\'), '<|', '<\|')) AS role_chars, length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text)))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_chars + CASE WHEN before IS NOT DISTINCT FROM role THEN 8 ELSE 9 + role_chars + 8 + 8 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lines.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), runs=True)
    return got.select("doc_id", "removed_chunks", F.length("text").cast("bigint").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(range(1, len(ls) + 1)) AS n, unnest(ls) AS x FROM d),
w AS (SELECT r, doc_id, n, x || chr(10) || lead(x) OVER (PARTITION BY r ORDER BY n) AS y FROM l),
again AS (SELECT r, n FROM (SELECT r, n, row_number() OVER (PARTITION BY y ORDER BY doc_id, n) AS k FROM w WHERE y <> chr(10)) WHERE k > 1),
g AS (SELECT r, n FROM again UNION SELECT r, n + 1 FROM again),
z AS (SELECT l.*, g.n IS NOT NULL AS gone, x = '' AND g.n IS NULL AS hollow FROM l LEFT JOIN g USING (r, n)),
e AS (SELECT *, bool_or(gone) OVER (PARTITION BY r) AS cut, last_value(CASE WHEN NOT hollow THEN gone END IGNORE NULLS) OVER (PARTITION BY r ORDER BY n ROWS UNBOUNDED PRECEDING) AS before,
  first_value(CASE WHEN NOT hollow THEN gone END IGNORE NULLS) OVER (PARTITION BY r ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM z),
o AS (SELECT r, n, x, gone OR (hollow AND cut AND coalesce(before, true) AND coalesce(after, true)) AS gone FROM e),
c AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY n), false) AS first FROM o),
k AS (SELECT r, count(*) FILTER (first) AS runs, coalesce(string_agg(x, chr(10) ORDER BY n) FILTER (NOT gone), '') AS kept FROM c GROUP BY r)
SELECT doc_id, coalesce(runs, 0)::BIGINT AS removed_chunks, length(kept)::BIGINT AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP5_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER.format('text')}, '{WORD}'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, l.y FROM reach JOIN l ON l.x = reach.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.b AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) c ON c.a = d.doc_id
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substrings.dedup(read(spark, sf_dir, "documents"))
    n = F.aggregate("removed", F.lit(0).cast("bigint"), lambda z, s: z + s.n_words)
    return got.select("doc_id", "n_words", n.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w FROM documents),
t AS (SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS g FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d)),
m AS (SELECT g, min(doc_id) AS least FROM t GROUP BY g HAVING count(*) > 1),
hit AS (SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM t JOIN m USING (g) WHERE doc_id > least) GROUP BY r),
u AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
h AS (SELECT r, unnest(ps) AS p, true AS gone FROM hit),
k AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(x, ' ' ORDER BY p) FILTER (gone IS NULL) AS kept FROM u LEFT JOIN h USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.dedup(read(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, l.y FROM reach JOIN l ON l.x = reach.b),
c AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept FROM v LEFT JOIN n ON x = vec_id JOIN c ON a = vec_id
"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffixes.dedup(read(spark, sf_dir, "documents"))
    n = F.aggregate("removed", F.lit(0).cast("bigint"), lambda z, s: z + s.end - s.begin)
    return got.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Windows as 128-bit digests of 400 bytes in hexadecimal; marked starts to runs; what is between the runs.
OP8_SQL = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
t AS MATERIALIZED (SELECT r, i, md5_number(substr(x, 2 * i - 1, 800)) AS g FROM (SELECT r, x, unnest(range(1, length(x) // 2 - 398)) AS i FROM d WHERE length(x) >= 800)),
m AS (SELECT r, i FROM t SEMI JOIN (SELECT g FROM t GROUP BY g HAVING count(*) > 1) USING (g)),
s AS (SELECT r, i, (i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000) + 400)::INT AS new FROM m),
k AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
u AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM k GROUP BY r, run),
p AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 1) AS c FROM u),
q AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * c - 1, 2 * (a - c)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) - 1) AS kept FROM p JOIN d USING (r) GROUP BY r)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN q USING (r)
"""


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.classify(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return got.select("doc_id", F.round("importance", 6).alias("importance"), "accepted")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_decontaminate": op1_decontaminate, "op2_mix_sources": op2_mix_sources, "op3_chat_format": op3_chat_format, "op4_line_dedup": op4_line_dedup, "op5_jaccard_join": op5_jaccard_join, "op6_substring_dedup": op6_substring_dedup, "op7_embedding_dedup": op7_embedding_dedup, "op8_suffix_dedup": op8_suffix_dedup, "op9_quality_classifier": op9_quality_classifier, "op10_lm_score": op10_lm_score}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1_SQL, "op2_mix_sources": OP2_SQL, "op3_chat_format": OP3_SQL, "op4_line_dedup": OP4_SQL, "op5_jaccard_join": OP5_SQL, "op6_substring_dedup": OP6_SQL, "op7_embedding_dedup": OP7_SQL, "op8_suffix_dedup": OP8_SQL}

"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscope.llm import byte_bpe
from tellerscope.llm.best_position import lexical_search
from tellerscope.llm.common import table
from tellerscope.llm.exact_dedup import exact_dedup
from tellerscope.llm.language_id import identify
from tellerscope.llm.line_dedup import line_dedup
from tellerscope.llm.maxscore import top_k
from tellerscope.llm.minhash import near_dedup
from tellerscope.llm.ngram_join import ngram_join
from tellerscope.llm.packing import pack
from tellerscope.llm.periodic_runs import longest, periodic_runs, with_planted_repeats
from tellerscope.llm.tool_calls import TURN_SCHEMAS, calls_of_turns, link_tool_calls
from tellerscope.llm.warc import warc_index
from tellerscope.llm.wavelet import token_files


def vocabulary(name: str) -> str:
    """A public vocabulary file; any other path can be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = ngram_join(table(spark, sf_dir, "documents"), k=3, similarity=(90, 100))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files(docs, vocabulary("byte_bpe_50k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("text_hash")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda r: F.concat_ws("-", r["start"], r["stop"]))
    return found.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.array_join(spans, " ").alias("removed_spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, vocabulary("word_bpe_49k.json"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = calls_of_turns(table(spark, sf_dir, "conversations"))
    return link_tool_calls(calls, results, TURN_SCHEMAS)


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    found = found.withColumn("best", longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), k=4, similarity=(80, 100)).drop("text_hash")


OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP4_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

OP5_SQL = """
WITH ends AS (
  SELECT doc_id, regexp_replace(text, '([.!?] |\n)', '\\1' || chr(1), 'g') AS marked FROM documents
), lists AS (
  SELECT doc_id, string_split(marked, chr(1)) AS parts FROM ends
), p AS (
  SELECT doc_id, i, parts[i] AS part, trim(regexp_replace(lower(parts[i]), '\\s+', ' ', 'g')) AS norm,
    CAST(coalesce(list_sum([length(x) FOR x IN parts[1:i - 1]]), 0) AS BIGINT) AS start
  FROM lists, unnest(range(1, len(parts) + 1)) AS t(i)
), placed AS (
  SELECT *, start + length(part) AS stop, CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS words,
    coalesce(sum(CAST(part LIKE '%' || chr(10) AS INT)) OVER before, 0) AS line,
    coalesce(sum(CAST(part = chr(10) AS INT)) OVER before, 0) AS paragraph
  FROM p WINDOW before AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), ended AS (
  SELECT *, max(i) OVER (PARTITION BY doc_id, line) AS line_end FROM placed
), f AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto, upto - words AS before,
    coalesce(lead(i) OVER (PARTITION BY doc_id, line ORDER BY i) - 1, line_end) AS closed
  FROM ended WHERE words > 0
), runs AS (
  SELECT b.doc_id, a.i AS first, b.i AS last FROM f b ASOF JOIN f a ON b.doc_id = a.doc_id AND b.upto - 8 >= a.before
  UNION SELECT a.doc_id, a.i, b.i FROM f a ASOF JOIN f b ON a.doc_id = b.doc_id AND a.before + 8 <= b.upto
  UNION SELECT doc_id, min(i), max(i) FROM f GROUP BY doc_id, line HAVING sum(words) >= 8
  UNION SELECT doc_id, min(i), max(i) FROM f GROUP BY doc_id, paragraph HAVING sum(words) >= 8
), u AS (
  SELECT r.doc_id, r.first, any_value(e.closed) AS last, min(f.start) AS start,
    string_agg(f.norm, ' ' ORDER BY f.i) AS norm
  FROM runs r JOIN f ON f.doc_id = r.doc_id AND f.i BETWEEN r.first AND r.last
  JOIN f e ON e.doc_id = r.doc_id AND e.i = r.last
  GROUP BY r.doc_id, r.first, r.last
), units AS (
  SELECT u.*, p.stop FROM u JOIN placed p ON p.doc_id = u.doc_id AND p.i = u.last
), ranked AS (
  SELECT *, first_value({'doc': doc_id, 'stop': stop}) OVER (PARTITION BY norm ORDER BY doc_id, start, stop) AS earliest FROM units
), gone AS (
  SELECT DISTINCT p.doc_id, p.i, p.start, p.stop FROM ranked r JOIN placed p ON p.doc_id = r.doc_id AND p.i BETWEEN r.first AND r.last
  WHERE NOT (r.doc_id = r.earliest.doc AND r.start < r.earliest.stop)
), islands AS (
  SELECT doc_id, min(start) AS start, max(stop) AS stop
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM gone) GROUP BY doc_id, island
), spans AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(start || '-' || stop, ' ' ORDER BY start) AS removed_spans
  FROM islands GROUP BY 1
), texts AS (
  SELECT p.doc_id, coalesce(string_agg(p.part, '' ORDER BY p.i) FILTER (g.i IS NULL), '') AS text
  FROM p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY 1
)
SELECT doc_id, text, coalesce(n_removed, 0) AS n_removed, coalesce(removed_spans, '') AS removed_spans
FROM texts LEFT JOIN spans USING (doc_id)
"""

OP9_SQL = """
WITH c AS (
  SELECT conv_id, turn, conv_id || ':' || turn AS call_id, text FROM conversations WHERE role = 'user'
), a AS (
  SELECT conv_id, conv_id || ':' || (turn - 1) AS call_id, turn, text AS content
  FROM conversations WHERE role = 'assistant'
), r AS (
  SELECT coalesce(c.conv_id, a.conv_id) AS conv_id, coalesce(c.turn, a.turn) AS turn,
    coalesce(c.call_id, a.call_id) AS call_id, 0 AS level,
    CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN a.call_id IS NULL THEN 'pending' ELSE 'answered' END AS status,
    CAST(a.call_id IS NOT NULL AS BIGINT) AS n_results,
    CASE WHEN c.call_id IS NULL THEN 'no call' WHEN c.text IS NULL THEN 'missing prompt' ELSE '' END AS errors,
    c.text, a.content, c.turn AS asked
  FROM c FULL JOIN a ON c.conv_id = a.conv_id AND c.call_id = a.call_id
)
SELECT conv_id, turn, call_id, level, status, n_results, errors = '' AS valid, errors,
  '{"arguments":' || CASE WHEN status = 'orphan' THEN 'null' WHEN text IS NULL THEN '{"turn":' || asked || '}'
      ELSE '{"prompt":' || to_json(text) || ',"turn":' || asked || '}' END
  || ',"call_id":"' || call_id || '","content":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null')
  || ',"conv_id":' || conv_id || ',"errors":[' || CASE WHEN errors = '' THEN '' ELSE '"' || errors || '"' END
  || '],"level":0,"name":' || CASE WHEN status = 'orphan' THEN 'null' ELSE '"respond"' END
  || ',"status":"' || status || '","turn":' || turn || '}' AS json
FROM r
"""

OP10_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP12_SQL = """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), lengths AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY 1
), totals AS (
  SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM lengths
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY 1
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // total)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_warc": op2_warc,
        "op3_token_files": op3_token_files,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_line_dedup": op5_line_dedup,
        "op6_packing": op6_packing,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_language_id": op8_language_id,
        "op9_tool_calls": op9_tool_calls,
        "op10_exact_top_k": op10_exact_top_k,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_best_position": op12_best_position,
        "op13_minhash": op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op5_line_dedup": OP5_SQL, "op9_tool_calls": OP9_SQL, "op10_exact_top_k": OP10_SQL, "op12_best_position": OP12_SQL}

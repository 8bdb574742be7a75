"""The registered queries of this package (``opN_name``) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        LLM_QUERIES[name] = f
        if sql:
            LLM_ORACLE_SQL[name] = sql
        return f
    return add


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import token_pieces
    from .pack_bestfit import pack

    placed = pack(token_pieces(table(spark, sf_dir, "documents"), capacity=1024, end_id=2), capacity=1024,
                  order_by=("doc_id", "piece", "ids_crc32"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op5_forced_boundary_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import decode_ids, encode_texts

    decoded = decode_ids(encode_texts(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# Keys of 40 code points or more found in 5 documents or more; a line's key is stripped of ASCII white space, A-Z lower-cased.
OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.i AS i, string_split(coalesce(text, ''), chr(10))[u.i] AS line
  FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i) u),
keyed AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
gone AS (
  SELECT k, max(doc_id) AS best FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.i, l.line, g.k IS NOT NULL AND l.doc_id <> g.best AS dropped
  FROM keyed l LEFT JOIN gone g ON l.k = g.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CAST(dropped AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op8_line_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_repeated_lines

    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    marked = near_duplicates(table(spark, sf_dir, "documents"), k=4, distance=4)
    return marked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@query("op10_compression_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import held_out, identify, learn_dictionaries

    docs = table(spark, sf_dir, "documents")
    told = identify(docs, learn_dictionaries(docs.where(~held_out("doc_id"))))
    return told.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@query("op2_prefix_target_chat")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_prefix import prefix_target_examples, read_back

    tricky = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return read_back(prefix_target_examples(turns)).withColumnRenamed("conv", "conv_id")


# Host suffix and path prefix of the four rules; the longest that fits decides.
OP3_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)', 2, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(.*?)://[^/?#]*([^?#]*)', 2, 's'), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
judged AS (
  SELECT p.page_id, p.host, p.path, (
    SELECT max(struct_pack(l := length(r.rhost || r.rpath), rule := r.rhost || r.rpath, verdict := r.verdict)) FROM rules r
    WHERE (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)) AS b
  FROM parts p)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM judged
"""


@query("op3_url_rules", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_rules import judge_urls, rule_table

    rules = rule_table(spark, [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")])
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op1_one_bit_neighbours")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann_onebit import nearest

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), depth=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_iblt_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .iblt import versions

    return versions(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op11_vector_bin_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_texts
    from .vector_packing import pack_examples

    return pack_examples(encode_texts(table(spark, sf_dir, "documents"), cut_words=False), capacity=1024, max_segments=64, end_id=0)


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_alignment import align_and_count

    return align_and_count(table(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), components=8).withColumn("deviation", F.col("deviation").cast("long"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)

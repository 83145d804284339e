"""The registered queries of the numbered operators: thin, over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    chat, host_rules, ngram_join, packing, pii, quality_rank, runs, sentencepiece_fst, shards, topk, toxicity, turn_repair,
    warc,
)
from .common import Scratch, read_table


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine and the workers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark, sf_dir):
    return ngram_join.similar_texts(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.with_severity(docs.select("doc_id", "text"), model).select(
        "doc_id", "expected_severity", "severity", "toxic")


def op3_bit_sliced_topk(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.nearest(vectors, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score")


def op4_sentencepiece(spark, sf_dir):
    return sentencepiece_fst.encoded(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_quality_rank(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return quality_rank.scored(docs, quality_rank.train(docs, read_table(spark, sf_dir, "labels")))


def op6_pii(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, pii.application_key(spark))


def op7_chat_format(spark, sf_dir):
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit("<|im_end|><|im_start|>assistant ok").alias("text"))
    return chat.digests(chat.canonical(table.unionByName(said)))


def op8_kd_shards(spark, sf_dir):
    placed = shards.sharded(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_host_rules(spark, sf_dir):
    return host_rules.verdicts(read_table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_warc(spark, sf_dir):
    path = f"{Scratch(spark, 'archive').root}/pages"
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_runs(spark, sf_dir):
    return runs.run_digests(read_table(spark, sf_dir, "documents"), deal=True)


def op13_turn_repair(spark, sf_dir):
    return turn_repair.summaries(turn_repair.damaged(read_table(spark, sf_dir, "conversations")))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_toxicity, op3_bit_sliced_topk, op4_sentencepiece, op5_quality_rank, op6_pii, op7_chat_format,
    op8_kd_shards, op9_host_rules, op10_packing, op11_warc, op12_runs, op13_turn_repair, pipeline)}

OP9_SQL = r"""
WITH base AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM base),
wins AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
twice AS (SELECT doc_id, g FROM wins GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM wins JOIN twice USING (doc_id, g), (VALUES (0), (1), (2)) AS v(o)
  GROUP BY doc_id),
scored AS (
  SELECT p.doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM parts p LEFT JOIN covered c ON p.doc_id = c.doc_id),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM scored),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS f FROM failed WHERE host IS NOT NULL GROUP BY host),
prior AS (
  SELECT sum(f) / sum(n) AS m, sum(n) AS total, avg((f / n) ** 2) AS m2, avg(f / n) AS m1, avg(1 / n) AS inv FROM hosts),
spread AS (SELECT *, m * (1 - m) AS noise, m2 - m1 ** 2 - m * (1 - m) * inv AS excess FROM prior),
strong AS (
  SELECT m, CASE WHEN excess > 0 THEN least(greatest(noise / excess - 1, 1e-3), total) ELSE total END AS s FROM spread),
bad AS (SELECT host FROM hosts, strong WHERE (f + m * s) / (n + s) >= 0.7)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(host NOT IN (SELECT host FROM bad), true) AS kept
FROM failed
"""

OP3_SQL = """
WITH parts AS (
  SELECT vec_id, j, floor(256 * embedding[j]::DOUBLE)::BIGINT AS x
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS j FROM embeddings
        WHERE vec_id IS NOT NULL AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.j = c.j AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""

OP7_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
  FROM range(2) r(i)),
said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))
             + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))
             + length('<|im_start|>') + 1 + length('<|im_end|>') + 1) AS chars
  FROM rows_ GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM said
"""

OP11_SQL = """
WITH sized AS (
  SELECT page_id, url, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS hex FROM pages),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS nth,
         max(page_id) OVER (PARTITION BY t) AS best FROM sized)
SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)
                        for i in range(32)], '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN best END AS refers_to
FROM ranked
"""

ORACLE = {"op11_warc": OP11_SQL, "op3_bit_sliced_topk": OP3_SQL, "op7_chat_format": OP7_SQL, "op9_host_rules": OP9_SQL}

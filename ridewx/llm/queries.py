"""The registered queries of the subpackage, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewx.llm import (bagminhash, chat_windows, collision_projections, golomb_dedup, langid, line_rules, mixing,
                        pow2_pack, prefix_trie, quality_crf, setm_phrases, suffix_trees, toxicity_gbt)
from ridewx.llm.common import SPACE_RUN
from ridewx.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str, folds: int, held: int) -> Column:
    """Whether a document is in the held-out fold."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == held, F.lit(False))


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three folds of four."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~fold("doc_id", 4, 2))
    return langid.predict(docs, model).select(
        "doc_id", fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def _scored(scores: DataFrame, folds: int, held: int) -> DataFrame:
    return scores.select("doc_id", fold("doc_id", folds, held).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"), ~fold("id", 3, 1))
    return _scored(quality_crf.score(docs, model), 3, 1)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return (bagminhash.near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "class_id", "class_size", "kept"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and the digest of their ids."""
    return pow2_pack.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate group of every document."""
    return golomb_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base metrics and verdict of every document."""
    return line_rules.clean(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_gbt.train(docs, table(spark, sf_dir, "labels"), ~fold("id", 5, 0))
    return _scored(toxicity_gbt.score(docs, model), 5, 0)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 20-word windows."""
    out = suffix_trees.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


PROBE = "</s>[INST] ok [/INST]"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and the probe, read back from windows."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat_windows.read_back(chat_windows.windows(turns.unionByName(probe)))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.9."""
    return collision_projections.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the rebuilt conversations' prefix trie, with subtree totals."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every lang."""
    return setm_phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_langid, op2_quality_crf, op3_near_dedup, op4_packing, op5_exact_dedup,
                            op6_quality_rules, op7_toxicity, op8_substring_dedup, op9_chat_format,
                            op10_mixing, op11_embedding_dedup, op12_prefix_trie, op13_collocations,
                            pipeline)}

_EXACT = f"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE_RUN}', ' ', 'g')) AS text_sha256,
                  regexp_replace(coalesce(text, ''), '{SPACE_RUN}', ' ', 'g') AS t FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS rn FROM n)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM g
"""

_WINDOWED = """
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (SELECT r, doc_id, i, sha256(array_to_string(words[i:i + 19], ' ')) AS g
      FROM (SELECT r, doc_id, words, unnest(generate_series(1, len(words) - 19)) AS i FROM w)),
later AS (SELECT r, i FROM s QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, r, i) > 1),
gone AS (SELECT r, list(DISTINCT p) AS places
         FROM (SELECT r, unnest(generate_series(i, i + 19)) AS p FROM later) GROUP BY r),
words AS (SELECT r, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM w),
removed AS (SELECT r, unnest(places) AS p FROM gone),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
         FROM words ANTI JOIN removed USING (r, p) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
"""

# The windows of a conversation follow from running token sums, one turn at a time.
_B, _H = chat_windows.BUDGET, chat_windows.HISTORY
_CHAT = rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS k,
        replace(replace(replace(text, '\', '\e'), '<', '\l'), '[', '\b') AS body,
        replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\b') AS head FROM c),
t AS (SELECT *, strlen(head) + strlen(body) + 14 AS tokens,
        length(head) + length(body) + 14 AS chars, k = 0 AND role = 'system' AS sys FROM e),
s AS (SELECT conv_id, max(CASE WHEN sys THEN tokens ELSE 0 END) AS stok,
        max(CASE WHEN sys THEN chars ELSE 0 END) AS schars, count(*) AS n,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss
      FROM t GROUP BY conv_id),
walk AS (
  SELECT conv_id, k, tokens, chars, sys, tokens AS used, true AS opens, 0::BIGINT AS h1t, 0::BIGINT AS h1c, 0::BIGINT AS h2t, 0::BIGINT AS h2c
  FROM t WHERE k = 0
  UNION ALL
  SELECT t.conv_id, t.k, t.tokens, t.chars, false,
    CASE WHEN w.sys OR t.k % {chat_windows.SEGMENT} = 0 OR w.used + t.tokens > {_B - _H} - stok
         THEN t.tokens ELSE w.used + t.tokens END,
    w.sys OR t.k % {chat_windows.SEGMENT} = 0 OR w.used + t.tokens > {_B - _H} - stok,
    CASE WHEN w.sys THEN 0 ELSE w.tokens END, CASE WHEN w.sys THEN 0 ELSE w.chars END, w.h1t, w.h1c
  FROM walk w JOIN t ON t.conv_id = w.conv_id AND t.k = w.k + 1 JOIN s ON s.conv_id = t.conv_id),
f AS (SELECT conv_id, sum(CASE WHEN sys THEN 0 ELSE chars END
        + CASE WHEN opens AND NOT sys AND k > 0 THEN
            CASE WHEN h1t <= {_H} THEN h1c + CASE WHEN h1t + h2t <= {_H} THEN h2c ELSE 0 END ELSE 0 END
          ELSE 0 END) AS chars,
        count(*) FILTER (opens AND NOT sys) AS spans FROM walk GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, (f.chars + greatest(spans, 1) * schars)::BIGINT AS formatted_chars
FROM s JOIN f USING (conv_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": _EXACT,
    "op6_quality_rules": line_rules.ORACLE_SQL,
    "op8_substring_dedup": _WINDOWED,
    "op9_chat_format": _CHAT,
    "op11_embedding_dedup": collision_projections.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_collocations": setm_phrases.ORACLE_SQL,
}

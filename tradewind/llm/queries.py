"""One query per operator of this package, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import (
    chaining,
    conversations,
    flatgraph,
    language,
    minhash,
    mixing,
    neighbours,
    packing,
    quality,
    spelling,
    suffixes,
    tokenfiles,
    toxicity,
)
from tradewind.llm.common import table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fair schedule of all documents, sources weighted by their size to the power 0.9."""
    return mixing.schedule(table(spark, sf_dir, "documents")).drop("key")


def op3_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings."""
    return flatgraph.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, with the offending sentences."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without repeated strings of 400 bytes."""
    return suffixes.repeat_digest(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return language.predicted_languages(table(spark, sf_dir, "documents"))


def op8_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents share, edits allowed."""
    return chaining.shared_passages(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed into sequences of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest of all embeddings for every twentieth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the form they vary, a thirty-first of them damaged."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written to addressable files and read back."""
    return tokenfiles.token_digest(table(spark, sf_dir, "documents"), tokenfiles.tokenizer_path())


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return conversations.repair_digest(conversations.damaged(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash": op1_minhash,
        "op2_mixing": op2_mixing,
        "op3_flat_graph": op3_flat_graph,
        "op4_quality": op4_quality,
        "op5_toxicity": op5_toxicity,
        "op6_suffix_array": op6_suffix_array,
        "op7_language": op7_language,
        "op8_chaining": op8_chaining,
        "op9_packing": op9_packing,
        "op10_multiprobe": op10_multiprobe,
        "op11_spelling": op11_spelling,
        "op12_token_files": op12_token_files,
        "op13_conversations": op13_conversations,
    }


# Words are cut at the six ASCII blanks and lower-cased in A-Z only; the set of a text of
# fewer than five words is its whole word sequence.
_MINHASH = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id,
  doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


# Components follow all links; the table has no missing or zero vectors.
_FLAT_GRAPH = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other
), counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n_links), 0) AS n_links, min(other) AS component_id,
  vec_id = min(other) AS kept
FROM reach LEFT JOIN counts USING (vec_id) GROUP BY vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash": _MINHASH, "op3_flat_graph": _FLAT_GRAPH}

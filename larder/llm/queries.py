"""The registered queries of the subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_folder
from . import fingerprints, frames, languages, lexical, ordinal, outliers, packing, pieces, projections, simhash, tokencache, toxicity, warc
from .tables import read, ready, remainder, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# SQL that DuckDB runs on the same tables, where SQL can express the query.
ORACLES: dict[str, str] = {
    "op1_warc_captures": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        m AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS f FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN f <> page_id THEN f END AS refers_to, 1 AS n_requests, 1 AS n_metadata
        FROM m""",
    "op5_sorted_projections": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        l AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        r(vec_id, reached) AS (
            SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reached = l.a),
        c AS (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id),
        n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
        SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept
        FROM c LEFT JOIN n ON c.vec_id = n.a""",
    "op12_shared_sums_ranking": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        s AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_words FROM d),
        p AS (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d),
        t AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
        i AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        q AS (SELECT item_id, term, count(*) AS r FROM i GROUP BY ALL),
        f AS (SELECT term, count(*) AS df FROM t SEMI JOIN q USING (term) GROUP BY term),
        w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM f, s),
        v AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_words)))) AS v
            FROM t JOIN w USING (term), s),
        a AS (SELECT item_id, doc_id, CAST(sum(r * v) AS BIGINT) AS score FROM q JOIN v USING (term) GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM a WHERE score > 0 QUALIFY rank <= 10""",
    "op13_framed_fill_in_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS x FROM documents),
        h AS (
            SELECT *, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
                CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
        c AS (
            SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM h),
        p AS (SELECT *, substr(t, 1, lo) AS pre, substr(t, lo + 1, hi - lo) AS mid, substr(t, hi + 1) AS suf FROM c)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
        FROM p""",
}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(ready(spark), sf_dir)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


@query
def op1_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(spark, read(spark, sf_dir, "pages"), fresh_folder(spark, "archives"))


@query
def op2_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs, labels, remainder("doc_id", 3) != 1)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query
def op3_distinct_chunk_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents"), PIECE_BPE, ("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op4_hyperdimensional_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages.identify(read(spark, sf_dir, "documents"), remainder("doc_id", 4) != 2)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op5_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(read(spark, sf_dir, "embeddings"))


@query
def op6_mcd_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.robust_outliers(read(spark, sf_dir, "documents"))


@query
def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = ordinal.quality(docs, labels, remainder("doc_id", 3) != 1)
    tails = [F.col("tails")[k].alias(f"tail_{k + 1}") for k in range(2)]
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "expected_grade", *tails, "kept")


@query
def op8_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


@query
def op9_digest_cache_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencache.token_counts(read(spark, sf_dir, "documents"), BYTE_BPE, fresh_folder(spark, "token-cache"))


@query
def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), BYTE_BPE, BYTE_RANKS)


@query
def op11_block_table_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts; those with an id divisible by 100 are searched for in all."""
    return fingerprints.document_fingerprints(read(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0)


@query
def op12_shared_sums_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item, over all documents."""
    return lexical.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op13_framed_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents stored in frames, rearranged, and rebuilt: digests of both texts."""
    stored = stage(frames.store(read(spark, sf_dir, "documents")), "frames")
    return frames.digests(frames.fill_in_middle(stored))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)

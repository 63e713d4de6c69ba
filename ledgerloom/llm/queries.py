"""The registered queries of the corpus operators, over whole tables, next to their DuckDB SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.alignment import alignment_counts
from ledgerloom.llm.common import documents, tokenizer
from ledgerloom.llm.exact_dedup import exact_groups
from ledgerloom.llm.itq import near_vectors
from ledgerloom.llm.language import identify
from ledgerloom.llm.lz_fingerprint import neighbour_fingerprints
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.piece_bpe import encode_digests
from ledgerloom.llm.rlz import drop_repeated_words
from ledgerloom.llm.secrets import scan_documents
from ledgerloom.llm.sharding import shard_documents
from ledgerloom.llm.simhash import simhash_components
from ledgerloom.llm.suffix_dedup import drop_repeated_bytes
from ledgerloom.llm.whitening import whiten

SHARDS = 24


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "pieces")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(documents(spark, sf_dir))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_bytes(documents(spark, sf_dir)).drop("kept")


def op5_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(documents(spark, sf_dir))


def op6_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op8_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_words(documents(spark, sf_dir)).drop("kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir), words=3, max_bits=2)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(documents(spark, sf_dir), largest=True)
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op12_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(embeddings(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(embeddings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_language_id": op2_language_id,
    "op3_secret_scan": op3_secret_scan,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_lz_fingerprint": op5_lz_fingerprint,
    "op6_feistel_shards": op6_feistel_shards,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_rlz_dedup": op8_rlz_dedup,
    "op9_simhash": op9_simhash,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_itq_dedup": op12_itq_dedup,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op4_suffix_array_dedup": """
        WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        windows AS (
            SELECT doc_id, p, substr(h, 2 * p - 1, 200) AS w
            FROM (SELECT doc_id, h, unnest(generate_series(1, length(h) // 2 - 99)) AS p FROM texts)
        ), later AS (
            SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
        ), bytes AS (
            SELECT doc_id, p, substr(h, 2 * p - 1, 2) AS b FROM (SELECT doc_id, h, unnest(generate_series(1, length(h) // 2)) AS p FROM texts)
        ), near AS (
            SELECT b.doc_id, b.p, b.b, l.p IS NOT NULL AND l.p > b.p - 100 AS gone FROM bytes b ASOF LEFT JOIN later l ON b.doc_id = l.doc_id AND b.p >= l.p
        ), marked AS (
            SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS head FROM near
        ), kept AS (
            SELECT doc_id, sum(gone::INT)::BIGINT AS n_removed, sum(head::INT)::BIGINT AS n_spans,
                   coalesce(string_agg(b, '' ORDER BY p) FILTER (NOT gone), '') AS left_over
            FROM marked GROUP BY doc_id
        )
        SELECT t.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(left_over, ''))) AS kept_sha256
        FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
    """,
    "op8_rlz_dedup": r"""
        WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        windows AS (
            SELECT doc_id, p, array_to_string(ws[p : p + 34], ' ') AS w
            FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS p FROM texts)
        ), again AS (
            SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY w) AS k FROM windows) WHERE k > 1
        ), words AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS p, unnest(ws) AS word FROM texts),
        near AS (
            SELECT w.doc_id, w.p, w.word, a.p IS NOT NULL AND a.p > w.p - 35 AS gone FROM words w ASOF LEFT JOIN again a ON w.doc_id = a.doc_id AND w.p >= a.p
        ), kept AS (
            SELECT doc_id, sum(gone::INT)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS left_over
            FROM near GROUP BY doc_id
        )
        SELECT t.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
        FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
    """,
    "op10_exact_dedup": """
        WITH folded AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), grouped AS (
            SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, t
            FROM folded
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM grouped
    """,
    "op12_itq_dedup": """
        WITH RECURSIVE good AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
              AND len(list_filter(embedding, lambda c: c <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach AS (
            SELECT vec_id AS u, vec_id AS v FROM embeddings
            UNION
            SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
        ), roots AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u),
        counts AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM roots LEFT JOIN counts USING (vec_id)
    """,
}

"""From raw documents to token ids: languages, exact copies, near copies, source mix, SentencePiece ids."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import documents, tokenizer
from ledgerloom.llm.exact_dedup import drop_exact_copies
from ledgerloom.llm.language import drop_undetermined
from ledgerloom.llm.mixing import mix_documents
from ledgerloom.llm.piece_bpe import encode_column
from ledgerloom.llm.simhash import drop_near_copies
from ledgerloom.session import cut

MODEL = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, which becomes their ``lang``; those without text or letters go.

    An empty table stays empty; where no label teaches a language, ``lang`` stays as it is. Columns of any name are kept."""
    return drop_undetermined(docs, tokenizer(MODEL))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id.

    Null and empty texts are equal; rows with null ids stay only where a group has no others. Columns of any name are kept."""
    return drop_exact_copies(docs, largest=True)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links of at most 2 bits connect (3-word shingles), the one with the smallest doc_id.

    Null texts and texts without words are one group, ids that are all null leave any one row. Columns of any name are kept."""
    return drop_near_copies(docs, words=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the sources' target proportions; a document can come up to three times, or not at all.

    A null source is a source, a null text has no words; rows that agree in id and text share what is taken of them. Columns of
    any name are kept."""
    return mix_documents(docs)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens, round_trip`` of every row of the mix; a null or empty text has no ids. Other columns
    are left out."""
    encoded = docs.select("doc_id", "lang", "source", encode_column(docs, tokenizer(MODEL), F.col("text")).alias("encoded"))
    return encoded.select("doc_id", "lang", "source", "encoded.ids", F.size("encoded.ids").alias("n_tokens"), "encoded.round_trip")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece_ids", sentencepiece_ids),
]

# Language models and SimHash are beyond SQL; tests/llm/test_pipeline.py works the stages out in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

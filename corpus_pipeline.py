"""From raw documents to token ids: language, exact and near copies, mixing, encoding.

Each stage calls one operator of ``ridgeworks.llm``, reads all that its predecessor kept and returns a table;
``run`` writes it as Parquet in the shared checkpoint folder and reads it again for the next. All stages but
the last return the columns of ``documents``. The mix takes blocks of words, so a document of which it takes
a part comes with that part as its text, and one that it takes twice comes twice.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeworks.llm import bpe, exact_dedup, langid, mixing, simhash
from ridgeworks.llm.common import whole, written

RANKS = "byte_bpe_multi_50k.tiktoken"
# a language of lower posterior is no answer; the text is rejected
LEAST_SCORE = 0.5
# SQL has neither n-gram backoff, SimHash components, multinomial draws nor byte-pair merges
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: texts without a letter, or between languages, go."""
    model = langid.LanguageModel(docs)
    # a text is told by its digest and the id beside it; what is decided of them, few rows, goes to the documents
    keys = [F.coalesce("doc_id", F.lit(-1)).alias("id_key"), F.xxhash64("text").alias("text_key")]
    found = model.identify(docs, F.struct(*keys), F.col("text"))
    sure = (F.col("found.lang_pred") != langid.NO_LANGUAGE) & (F.col("found.score") >= LEAST_SCORE)
    rejected = written(found.filter(~sure).select("row.*").distinct(), "pipeline-rejected")
    rows = docs.select(whole(docs).alias("row"), *keys)
    return rows.join(rejected, ["id_key", "text_key"], "left_anti").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each text, that with the largest doc_id."""
    index = exact_dedup.DigestIndex(spark)
    kept = exact_dedup.distinct_rows(docs, index)
    index.close()
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies, that with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take blocks of every source to its target weight."""
    return mixing.Mix(docs).texts()


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    encoded = bpe.encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""A training corpus from ``documents``: known languages, no near-duplicates, no secrets, mixed sources, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm import bpe, langid, mixing, reachable, secrets, simhash
from cargolens.session import scratch_path

#: Rank file of the tokenizer.
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: Columns that every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and null ones, have no language and go; all others stay as they are.

    They stay whatever language the network finds, and also where no labelled
    document could be learnt from.
    """
    network = langid.learn(docs)
    if network is None:
        return docs.select(*COLUMNS).filter(langid.has_letter("text"))
    found = langid.identify(docs.select(*COLUMNS), network)
    # a score of 0 is that of no letter, while "und" may be a label that was learnt
    return found.filter(F.col("language.score") > 0).select(*COLUMNS)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the document with the smallest id stays."""
    classes = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    return simhash.one_of_each(docs.select(*COLUMNS), classes)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark."""
    clean = secrets.redact(secrets.scan(docs.select(*COLUMNS)))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes of a document."""
    mixed = mixing.mix(docs.select(*COLUMNS))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix.copies").cast("int"))).alias("_copy")
    return mixed.select(*COLUMNS, copies).drop("_copy")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every copy."""
    return bpe.encode(docs, bpe.Vocabulary.read(VOCABULARY))


STAGES = [
    ("language id", known_language),
    ("simhash near-dedup", one_of_near_duplicates),
    ("secret scan", without_secrets),
    ("source mix", mixed_sources),
    ("byte-level bpe", token_ids),
]

#: XXH64, a trained network and BPE merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""A corpus pipeline over ``documents``: each stage is one operator of ``meterflow.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns a
DataFrame; the result is written as Parquet in the shared folder and read again as the next
stage's input. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import bayesjoin, bytecnn, decontam, mixing, scratch, secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Score from which the network's word that a text is no language is taken; on sf0.01 it holds
#: no document labelled good for junk at any score, and nine in ten made-up ones score more.
JUNK_SCORE = 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language, a null ``lang`` filled by the prediction.

    Documents without a letter go, and those that the network holds for no language with a
    score of ``JUNK_SCORE`` at least. Texts shorter than one of its windows are not judged: a
    key or a number in a few words outweighs them.
    """
    docs = docs.select(*COLUMNS)
    found = bytecnn.identify(docs, bytecnn.trained_on(docs, junk=True)).where(F.col("lang_pred") != bytecnn.UNKNOWN)
    junk = F.col("lang_pred") == bytecnn.JUNK
    sure = (F.length("text") >= bytecnn.WINDOW) & (F.col("score") >= JUNK_SCORE)
    lang = F.coalesce("lang", F.when(~junk, F.col("lang_pred")))
    return found.where(~(junk & sure)).withColumn("lang", lang).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bayesjoin.keep_one(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontam.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and ``n_chars`` renewed."""
    return secrets.redact(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents, with domain, tokens and the number of epochs."""
    return mixing.mix(docs.select(*COLUMNS), mixing.domain_of(F.col("source")), mixing.QUERY_WEIGHTS)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
]

#: Language prediction and similarity search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.materialise(stage(spark, docs, sf_dir), name)
    return docs

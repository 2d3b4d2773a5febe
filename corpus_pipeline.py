"""From raw documents to token ids: five stages, each over all that the one before it kept.

1. language identification; documents without a language (``und``) go
2. n-gram Jaccard join; one document of each group of near copies stays
3. personal data and revealing terms are replaced in the texts
4. the sources are interleaved to their target weights: the rows come in that order
5. SentencePiece encoding, with the ids and the digests of the round trip, and each row's
   place in the mix (``block``, ``within``, ``release``, ``deadline``, ``slot``, ``in_target``):
   files keep no order, so the order of the mix is that of ``slot, within``

The stages in between return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlegap.llm.common import read_table, written
from candlegap.llm.language_id import UNKNOWN, identify, learn
from candlegap.llm.mixing import PLACED, mix, place
from candlegap.llm.ngram_join import one_of_each
from candlegap.llm.pii import sanitise
from candlegap.llm.sentencepiece_codec import default_model, encode_documents

#: Rows in one Arrow batch. Whole documents travel to Python and back here, so the batch, and
#: not the partition, is what a worker and its JVM hold at once.
BATCH_ROWS = 500
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    docs = docs.select(COLUMNS)
    return identify(docs, learn(docs), COLUMNS).where(F.col("lang_pred") != UNKNOWN).select("doc.*")


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return one_of_each(docs.select(COLUMNS))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    cleaned = sanitise(docs.select(COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs.select(COLUMNS))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    placed = place(docs.select(COLUMNS)).select("doc.doc_id", "doc.text", *[f"mix.{c}" for c in PLACED])
    return encode_documents(placed, default_model(), kept=PLACED)


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("pii", personal_data_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: Language models, set similarity and token ids have no SQL; the stages are tested against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Five stages over ``documents``: toxicity, language, near copies, secrets, packing.

Each stage takes what the one before has kept, as a written Parquet table, and works on all of it.  All but the last return the
columns they got.  The first two keep every document that they don't reject, the third one document
of each group of near copies, the fourth all documents with live-looking secrets masked, and the last
gives the pieces of the packed sequences.

Defined cases, for every stage: a null text counts as empty and stays null; repeated rows are kept or dropped alike, but
for near copies, of which the smallest ``doc_id`` stays (nulls last), of rows that share it the first; long texts are
read whole; an empty table gives an empty table; further columns stay as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import langid, packing, secrets, simhash, toxicity
from strata.llm.common import boxed, documents, table
from strata.session import ensure_checkpoint_dir, scratch_tables

#: Probability from which a document counts as toxic.
TOXIC = 0.5


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of ``toxic``, the last category of the chain, is below ``TOXIC``."""
    chain = toxicity.fit(documents(docs), table(spark, sf_dir, "labels"))
    scored = docs.select(boxed(docs).alias("doc"), toxicity.predict(chain)(F.coalesce("text", F.lit(""))).alias("p"))
    return scored.where(F.col("p.p_toxic") < TOXIC).select("doc.*")


def reject_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels know."""
    models = langid.fit(docs)
    if models is None:  # nothing to learn from: nothing to reject by
        return docs
    named = docs.select(boxed(docs).alias("doc"), langid.identify(models)(F.coalesce("text", F.lit(""))).alias("p"))
    return named.where(~F.col("p.rejected")).select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close fingerprints."""
    return simhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced; ``n_chars`` follows the text."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(
        *docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 ids."""
    return packing.pack(docs)


STAGES = [("toxicity", reject_toxic), ("language", reject_languages), ("near copies", drop_near_copies),
          ("secrets", mask_secrets), ("packing", pack)]

#: Fitted models and tokens have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again; the rows of the last one."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        with scratch_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            before = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{number - 1}")
            before.getFileSystem(spark._jsc.hadoopConfiguration()).delete(before, True)
    return docs

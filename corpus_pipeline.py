"""From raw documents to tokens: quality rules, near-duplicates, personal data, mixing, byte-pair encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the
columns of documents, the last adds to them. ``run`` writes each stage's rows as Parquet into the folder that
``spark.checkpoint.dir`` names and reads them back for the next one, so a lost executor costs at most a part of one stage; a
stage's folder goes once the next one stands.

Defined cases, in every stage: null and empty texts have no words, fail the base rule and go in the first stage; later stages
would keep them as they are. Very long texts are read whole. Of repeated rows, and of groups that tie, the near-duplicate stage keeps
one, the smallest id's; the other stages treat equal rows alike. Rows with a null id are judged by their text and kept after all others. Extra columns stay
with their values, whatever their names; only token_ids, n_tokens and decoded are the last stage's own. An empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import bpe, pii, poisson_mixing, quality_rules, simhash
from meterlake.llm.common import any_names, shared_folder, table
from meterlake.llm.queries import tokenizer_path


def whole(docs: DataFrame) -> Column:
    """All columns as one, ``row``, so that no operator takes one of them for its own."""
    return F.struct(*[docs[c] for c in docs.columns]).alias("row")


@any_names
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rule or a clause of the learned decision list rejects."""
    clauses = quality_rules.learn_from(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(whole(docs), "text")
    return quality_rules.judge(rows, clauses).where("kept").select("row.*")


@any_names
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of texts with a similarity of 0.8 or more of their five-word shingles: the smallest doc_id."""
    return simhash.keep_one(docs, groups_of=simhash.similar)


@any_names
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the new text."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


@any_names
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the target weights of their sources and shuffles them globally."""
    return poisson_mixing.mix(docs.select(whole(docs), "doc_id", "source")).select("row.*")


@any_names
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token_ids, n_tokens and decoded, the text that the tokens decode to."""
    return bpe.tokenised(docs, tokenizer_path(), decoded="decoded")


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("personal data", personal_data), ("mixing", mixed), ("byte-pair encoding", tokens)]

#: Learned rules, fingerprints and byte-pair merges have no SQL form; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, in whatever store it lies."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

"""Cleans a corpus in stages; each reads what the one before it wrote.

All stages but the last return the columns of ``documents``: they take rows out, and line dedup
shortens texts.  Rows without text or without id pass the filters, since nothing speaks against
them; empty texts come out of the last stage with no tokens.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.llm import bpe, line_runs, mixing, ngram_join, toxicity
from articlelake.llm.common import read
from articlelake.llm.queries import RANKS, TOXIC
from articlelake.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Documents are similar when 8 / 10 of their sequences of five words are common.
WORDS, NUM, DEN = 5, 8, 10


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold of the query."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("score") < TOXIC).select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut out; a document of which nothing is left goes."""
    cut = line_runs.delete_repeated_runs(docs.select(*COLUMNS))
    left = cut.where((F.col("n_deleted") == 0) | F.col("text").rlike(r"\S"))
    length = F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect the one with the smallest id stays, once."""
    similar = ngram_join.similar_documents(docs, WORDS, NUM, DEN)
    heads = settle(similar.where("component_id = doc_id").groupBy("doc_id").agg(F.count("*").alias("_rows")))
    if heads.count() <= ngram_join.SMALL:  # a checked size; beyond it, the join decides
        heads = F.broadcast(heads)
    kept = docs.select(*COLUMNS).join(heads, "doc_id")
    once = kept.where("_rows > 1").dropDuplicates(["doc_id"])  # an id on several rows
    return kept.where("_rows = 1").union(once).select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens have the target shares of sources, languages and topics."""
    return mixing.by_source_language_topic(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids, and of the bytes that they decode to."""
    return bpe.token_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", not_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed_to_targets),
    ("byte-level BPE", encoded),
]

# No SQL: a trained classifier, raking and a byte-level tokenizer are not expressible; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

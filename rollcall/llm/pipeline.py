"""The corpus pipeline: each stage takes (spark, docs, sf_dir), and its result is the next one's docs.

Language ID drops documents without letters and those that no language claims; quality rules drop what the base rule
or a learned rule names; of each group of near duplicates (five-word shingles, similarity 0.8) the document with the
smallest id stays; documents that hold a benchmark window go; what stays is encoded.

Defined results: every row is decided by itself. Documents without an id, and rows that repeat an id, are numbered for
the near-duplicate stage, of a group the smallest id stays (rows without one come last), and are told apart by their
text where hits of the benchmark are removed. Empty tables give empty tables; texts of any length are taken whole;
extra columns are kept. What no letter or no learned language claims goes in the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, language_id, quality_rules, sentencepiece_codec
from .common import materialise, table

BROADCAST = 1_000_000
NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 80, 100


def _small(written: DataFrame) -> DataFrame:
    """A written table of keys of 8 or 16 bytes, sent to all tasks where it has no more than BROADCAST rows."""
    return F.broadcast(written) if written.count() <= BROADCAST else written


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs less those with the ids."""
    return docs.join(_small(materialise(ids, "gone")), "doc_id", "left_anti").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return language_id.claimed(docs, model)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = docs.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("doc_id").alias("ids")).first()
    if ids.rows == ids.ids:
        groups = jaccard_join.join(docs, k=NEAR_WORDS, num=NEAR_NUM, den=NEAR_DEN)
        return _without(docs, groups.where("doc_id <> component_id").select("doc_id"))
    row = next(c for c in ("row", *(f"row{k}" for k in range(len(docs.columns) + 1))) if c not in docs.columns)
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = jaccard_join.join(numbered, id_col=row, k=NEAR_WORDS, num=NEAR_NUM, den=NEAR_DEN)
    named = groups.join(numbered.select(row, "doc_id"), row)
    best = named.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id"), F.col("doc_id"), F.col(row))).alias("b"))
    gone = materialise(named.join(best, "component_id").where(F.col(row) != F.col("b")[row]).select(row), "gone")
    return numbered.join(_small(gone), row, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = materialise(decontaminate.hits(docs, table(spark, sf_dir, "benchmark")).select("key"), "hits")
    return decontaminate.clean(docs, _small(found))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = sentencepiece_codec.encode(docs, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("language ID", language), ("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination), ("SentencePiece encoding", encoding)]
#: SQL cannot express the learned and iterative stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, "stage")
    return docs

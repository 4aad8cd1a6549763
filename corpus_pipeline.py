"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import fuzzy_lines, hamming_join, packing, pii, rule_ensemble
from arrears.llm.common import Scratch, documents
from arrears.llm.tokens import tokenizer_path

#: Documents scored below this are rejected.
LEAST_QUALITY = 0.3


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text now has."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    model = rule_ensemble.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "score"
    while score in docs.columns:
        score += "_"
    return rule_ensemble.scored(docs, model, score_col=score).where(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line that is a near copy of an earlier one goes."""
    return _counted(fuzzy_lines.without_repeated_lines(docs, Scratch(spark, "stage-lines")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8) one stays."""
    return hamming_join.without_near_duplicates(docs, Scratch(spark, "stage-near"), shingle_words=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes its kind in brackets."""
    return _counted(pii.redacted(docs, pii.fit(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near duplicates", near), ("personal data", private), ("packing", pack)]

#: SQL can't express the trees, the MinHash bands or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = documents(spark, sf_dir), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

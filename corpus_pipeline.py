"""Corpus pipeline: documents through five stages, each written as Parquet and read again.

1. toxicity: documents classified as toxic go.
2. near_duplicates: one document of each class of near copies (five-word shingles, Jaccard 0.8) stays.
3. decontamination: documents with a passage of the benchmark go.
4. personal_data: every span found is replaced by its kind in the text; ``n_chars`` follows.
5. mixing: documents sampled to the sources' target weights, with the words taken of each.

Rows with a null id or text pass the filters: nothing can be found in them. Extra columns are carried along as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.llm import decontaminate, mixing, ngramjoin, pii, toxicity
from corpusflow.llm.common import fold, load, stored


def _judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], keep: str) -> DataFrame:
    """The rows whose judged columns meet ``keep``, with the columns of ``docs`` alone, whatever their names."""
    packed = docs.select(F.struct("*").alias("_row"), F.col("text").alias("text"))
    return judge(packed).where(keep).select("_row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, load(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0))
    return _judged(docs, lambda d: toxicity.classify(d, model), "predicted = 0")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.representatives(docs, words=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _judged(docs, lambda d: decontaminate.decontaminate(d, load(spark, sf_dir, "benchmark")), "NOT contaminated")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).where("taken > 0")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("personal_data", redact_personal_data), ("mixing", mix_sources)]

# SQL expresses neither the classifier nor the trained span model; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Corpus pipeline over ``documents``: stages that each apply one operator to all rows the one before kept.

Language ID drops documents whose language it can't tell, the n-gram join keeps one document
of each group of near copies, decontamination drops documents with passages of ``benchmark``,
mixing keeps the documents of the source mix (once for every pass that takes them), and
sharding numbers what is left.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, read_table
from riskloom.llm.decontamination import remove_contaminated
from riskloom.llm.language_id import keep_identified
from riskloom.llm.mixing import materialise_mix
from riskloom.llm.ngram_join import keep_one_of_each
from riskloom.llm.sharding import sampled_splitter_shards

#: Least posterior of a language; below it a document is rejected.
LEAST_POSTERIOR = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, LEAST_POSTERIOR)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return materialise_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sampled_splitter_shards(docs)


STAGES = [("language ID", language_id), ("n-gram Jaccard join", ngram_join), ("benchmark decontamination", decontamination),
          ("mixing sources to target weights", mixing), ("sharding", sharding)]
#: Learned pieces and sampled keys have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs

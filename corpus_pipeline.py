"""A corpus pipeline: documents in, shards of a decontaminated, deduplicated mix out.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept
and returns a DataFrame; all but the last return the columns of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakelayer.llm import decontaminate, mixing, sharding, simhash, toxicity
from lakelayer.llm.common import TABLES, drop_tables, materialize, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    scored = toxicity.score(docs, read(spark, sf_dir, "labels"), toxicity.learnt_rows())
    return scored.filter("predicted = 0").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark")).filter("NOT contaminated").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' documents by weight, repeated up to twice, in the mix's order."""
    return mixing.mixed_documents(docs)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in 16 shards of near-equal bytes: the columns plus size, shard, slot."""
    return sharding.shard_records(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", to_shards),
]

# Model fits, fingerprints and sampled splitters have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared
    folder and read again by the next one.  Once it is written, the stage's input
    and the tables that the stage has written for itself go."""
    docs, since = read(spark, sf_dir, "documents"), len(TABLES)
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = materialize(docs)
            drop_tables(spark, since, keep=TABLES[-1:])
    return docs

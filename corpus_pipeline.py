"""Corpus pipeline over `documents`: quality rules, near-duplicates, private data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaystar.llm import mixing, packing, private_data, quality_rules, simhash
from quaystar.llm.common import stored, table, written_place
from quaystar.llm.queries import REST, WEIGHTS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that give it away are replaced in the texts."""
    return private_data.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix: the written files hold it from the first row to the last."""
    return mixing.mixed(docs, WEIGHTS, REST)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: shards and bins follow the order in which the documents were written."""
    return packing.pack(docs, order=written_place())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("private_data", private), ("mixing", mix), ("packing", pack)]
# The stages hash shingles, cut texts and pack bins in ways that SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage reads what the stage before it has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

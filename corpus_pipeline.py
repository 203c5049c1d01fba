"""Corpus preparation: quality rules, language ID, near-duplicate removal, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a
DataFrame, all but the last with the columns of ``documents``. ``run`` applies them to a whole
``documents`` table and writes each result to the shared checkpoint folder before the next stage reads it.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm import langid, near_dedup, packing, quality_rules
from ontime.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules.apply(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, by models of the stage's own rows with a language.

    Where no row has a language there is nothing to judge by, and every document is kept.
    """
    docs = docs.select(*COLUMNS)
    model = langid.fit(docs)
    return docs if model is None else langid.apply(docs, model).where("not rejected").select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Of rows that repeat an id the smallest stays; rows without id are never removed.
    """
    docs = docs.select(*COLUMNS)
    found = near_dedup.near_duplicates(docs)
    dropped = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    once = kept.join(repeated, "doc_id", "left_anti").select(*COLUMNS)
    rest = F.struct(*[c for c in COLUMNS if c != "doc_id"])
    twice = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(rest).alias("row")).select("doc_id", "row.*")
    return once.union(twice.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with the sequence and offset of each."""
    pieces = packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality_rules", rules_stage),
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: Language models and packing have no SQL form; the tests compare run() with plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs

"""A corpus from raw documents to packed training sequences, in stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and its result is
written and read again as the next one's documents. All but the last keep the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.llm import line_dedup, mixing, packing, simhash, toxicity
from leadspark.llm.shared import Workspace, table

RANKS = "byte_bpe_50k.tiktoken"


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an expected severity below the limit stay."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit_labels(docs, labels)
    found = toxicity.with_severity(docs, model)
    return found.where(F.col("severity") < toxicity.REJECT).select(*docs.columns)


def deduplicated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated passages go; documents made of them alone go with them."""
    return line_dedup.deduplicate(docs, drop_emptied=True).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences.

    A document may come several times; each copy is packed, and equal copies may take any
    of their places.
    """
    cut = packing.pieces(docs, RANKS)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", not_toxic),
    ("line dedup", deduplicated_lines),
    ("simhash near-dedup", without_near_copies),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]

#: Fingerprints, learned weights and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = work.store(stage(spark, docs, sf_dir), f"{number}-{name.replace(' ', '-')}")
    return docs

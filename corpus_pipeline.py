"""The corpus pipeline: documents in, packed training sequences out, one operator a stage.

Defined cases, beside those of the operators: a null text scores like an empty one and is an empty text after
line dedup; rows with a null id stay, as no stage can tell them apart by it; repeated rows are scored alike and
stay or go together but for near copies, of which one row with the smallest id stays; empty tables give empty
stages; columns beside ``doc_id`` and ``text`` are kept as they are, ``n_chars`` is counted anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.llm.common import read_table
from tideload.llm.decontamination import decontaminate
from tideload.llm.line_dedup import dedup_lines
from tideload.llm.packing import pack
from tideload.llm.simhash import keep_one
from tideload.llm.toxicity import fit, score
from tideload.session import staged

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model, threshold=0.7).where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go; documents stay, those left empty too."""
    return dedup_lines(docs, min_chars=10).withColumn("n_chars", F.char_length("text")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return keep_one(docs, shingle=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of training sequences, with their token ids."""
    return pack(docs, VOCABULARY, limit=1024).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Scores, fingerprints and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

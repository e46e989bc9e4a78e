"""The corpus pipeline: toxic documents out, then copies, then near copies, then packing.

``STAGES`` is a list of (name, function); each function takes (spark, docs, sf_dir) and all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallygrid.llm import exact, minhash, packing, toxicity
from tallygrid.llm.common import ship, small_batches, staged

REJECT = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score under ``REJECT``, all their columns untouched, however they are
    called. A NULL or empty text scores as the model has it, repeated rows alike; an empty
    table stays empty."""
    ship(spark)
    small_batches(spark)  # of whole texts; it holds for the later stages too
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    own = ("doc_id", "text")
    plain = [c if c in own else f"c{i}" for i, c in enumerate(docs.columns)]
    scored = toxicity.scored(docs.toDF(*plain), labels)
    return scored.where(scored["score"] < REJECT).select(*plain).toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest id."""
    ship(spark)
    return minhash.survivors(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of the documents lie in the packed sequences."""
    ship(spark)
    windows = packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packing.piece_rows(windows).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("packing", pack)]
# A learned score and a randomised sketch are no SQL; the tests hold run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

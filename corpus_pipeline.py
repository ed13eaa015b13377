"""From raw documents to packed training sequences, stage by stage.

Each stage is one operator of ``medalla.llm`` over all that the stage before it
kept.  A stage's function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's ``docs``: all but
the last have the columns of ``documents``.

1. quality: documents whose importance weight is too low for their Gumbel key
   to be among the k largest are rejected (model and limit from ``labels``).
2. line dedup: lines of recurring templates stay in one document; a document
   of which nothing is left goes.  ``n_chars`` follows the text.
3. near-dedup: of each group of near-duplicates the smallest doc_id stays.
4. decontamination: documents that hold ten consecutive words of a
   ``benchmark`` item go.
5. packing: what is left becomes token ids, packed into sequences of 2048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medalla.llm import decontaminate, line_templates, near_dups, pack, quality
from medalla.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_templates.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


#: Packing comes when the stages before it have grown the executors' JVMs, and the pipeline has time to spare.
PACKING_MEMORY = {"memo_pieces": 60_000, "encode_bytes": 1 << 18}


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (little-endian unsigned
    integers, 16-bit for this vocabulary), ids_crc32, sequence_id and offset."""
    return pack.packed(docs, **PACKING_MEMORY)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Hashed models, signatures and a tokenizer are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""From raw documents to packed sequences: quality rules, near duplicates, repeated spans, source mix, packing.

Every stage takes what the one before kept, written as Parquet and read again. All but the last return the columns
of ``documents``. The mix repeats rows by epoch and cuts one text per source at its budget; the last stage returns one
row per piece with its place in a sequence.

Defined cases, for all stages: an empty table gives an empty result; further columns, whatever their names, are carried
to the mix and left behind by packing; row numbers are written with the rows before anything joins on them, so that
lost executors or another number of splits change no row. What each stage does with nulls, blank or very long texts,
ties and repeated rows stands with it.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from braidwork.llm import mixing, packing, repetition, sigtree, spans
from braidwork.llm.common import own_folder

#: Graph iteration and packing figures depend on byte-pair ids, which SQL can't make.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the rules keep. A null, empty or blank text goes (fewer than 50 words), as does one that repeats
    itself; repeated rows are judged alike; nulls in other columns are kept; a long text is judged whole."""
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts: the smallest doc_id, null ids last, among equal ids the first row. Texts
    without a word link with nothing and stay; of repeated rows one stays; nulls in other columns are kept."""
    return sigtree.one_of_each_group(docs, 5, 75)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of 13 words that start in a smaller doc_id too (null counts as the largest). A text that loses
    words has its others joined by a space, one that loses all goes, null and blank texts stay as they are; rows of one
    id don't clean each other; nulls in other columns are kept."""
    return spans.deduplicated(docs, 13)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated by epoch up to their source's budget; of each source at most one use is cut, at the exact word. A
    null source is one of its own, the last; rows without a word stay once; equal ids are ordered by size."""
    return mixing.mixed_documents(docs, (5, 2, 1), 1.5, 2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset; a null or empty text is its end id alone, repeated
    rows are packed one by one, null ids pass through, a long text is cut into pieces."""
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("source_mix", source_mix),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{own_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

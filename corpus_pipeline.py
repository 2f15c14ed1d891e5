"""A training corpus from ``documents``: four stages, each of which works on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``, and any others that the table has, whatever their
names.  An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kithline.llm import packing, quality_cascade, simhash_similar, substring_dedup
from kithline.llm.common import stored

#: The end id of a packed document, and the ids of a sequence.
END, CAPACITY = 0, 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, at the limits for a corpus.

    A null or empty text, and one of fewer than three words, goes; texts are judged
    whole, however long; a limit that is reached but not passed does not reject; rows
    are judged one by one, so repeated ones alike, and ids do not matter.
    """
    return quality_cascade.kept_rows(docs, rules=quality_cascade.CORPUS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, linked directly or through others, one.

    That is the row of the smallest doc_id, then of the smallest MD5 of the text; null
    ids come last.  Repeated rows are linked, so one stays.  Rows of one id, or without
    one, whose texts are not alike all stay.  Null and empty texts are alike.
    """
    return simhash_similar.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages of 20 words or more that an earlier one has, or that they had before; those left without a word go.

    Earlier is a smaller doc_id, null ids last; of rows of one id, one.  Texts that lose
    nothing, also null and empty ones, stay byte for byte; ``n_chars`` follows the text.
    """
    return substring_dedup.removed_rows(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of each document with its ids and where it stands in the packed sequences.

    A null text is empty and has the end id only; a text of over 2048 tokens is cut;
    repeated rows and rows of one id are packed each; of sequences with equal room any
    takes a piece.  Columns beside doc_id and text are ignored.  Executors still hold
    what earlier stages used, so workers take small steps.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END, capacity=CAPACITY, with_ids=True, step=4 << 20, remembered=100_000)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages), ("packing", packed_sequences)]

#: Tokenisation and packing are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

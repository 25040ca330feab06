"""From raw documents to token ids: five stages, each written and read again by the caller or by :func:`run`.

A stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns a DataFrame; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmill.llm import bpe, jaccard, language, line_dedup, mixing
from gridmill.llm.queries import word_vocabulary
from gridmill.llm.shared import documents, stash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell; the others go.

    Null and empty texts and texts without a letter go; repeated rows stay or go together; a null doc_id
    counts as the empty text in the choice of training rows; an empty table gives an empty one, and so does
    one without a labelled row to learn from.
    """
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and with them documents that have nothing left.

    Null, empty and blank texts stay as they are; repeated rows are one place and treated alike; null ids
    come first in the order of places; an empty table gives an empty one.
    """
    return line_dedup.keep_first_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of least id.

    Null and blank texts are copies of each other; of repeated rows one stays; rows without an id or with a
    reused one are told apart by their text; an empty table gives an empty one.
    """
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it.

    A null source is a source of its own; documents without words are not taken; rows with equal id and
    size are taken together; an empty table gives an empty one.
    """
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with sums of the ids and of the decoded text.

    Null and empty texts have no ids; repeated rows and null ids come back as often as they stand there; an
    empty table gives an empty one.
    """
    return bpe.encode_documents(docs, word_vocabulary(), texts=True, slice_docs=500, memo_chunks=100_000).drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The language model and the tokenizer are beyond SQL.  Tests hold each stage's operator against brute force:
# forward-backward over whole texts, windows of lines, all pairs of sets, resharing and the tokenizers library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The training-data pipeline: documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; ``run`` writes each result as Parquet and reads it back.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mergestat.llm import ordinal_quality, pivotal_mix, simhash_decontam, simhash_mih, token_frames
from mergestat.llm.common import staged, table
from mergestat.llm.queries import tokenizer_path
from mergestat.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects.

    Null and empty texts are scored like any other; repeated rows are kept or go alike; at equal
    probability 0.5 a document stays; without ratings, or with an empty table, nothing is rejected.
    Input columns of any name are kept as they are.
    """
    ship_package(spark)
    model = ordinal_quality.train(docs, ordinal_quality.graded(table(spark, sf_dir, "labels")))
    return ordinal_quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate group.

    Texts without words (null, empty) have the fingerprint zero and form one group; of rows with the
    smallest id one stays; rows without an id stay only in a group that has none. An empty table gives
    no rows. Input columns of any name are kept.
    """
    ship_package(spark)
    return simhash_mih.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a near copy of a benchmark item.

    Null and empty texts hold no item and stay; repeated rows stay or go alike; items without words
    match nothing; an empty benchmark or table removes nothing. Input columns of any name are kept.
    """
    return simhash_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null texts have size 0; a null source is a source, the last; which rows of equal id, source
    and size are taken follows from their contents. An empty table gives no rows. Input columns of any
    name are kept.
    """
    return pivotal_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place and checksum of each row's ids, read back from the files written.

    A null or empty text holds the end id alone; null ids come first; repeated rows are written as
    often as they occur; an empty table gives no rows. Columns other than id and text are not written.
    """
    ship_package(spark)
    return token_frames.read_back(token_frames.write(docs, tokenizer_path()))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix), ("tokens", tokens)]

#: The classifier, fingerprints and token ids have no SQL; each operator is tested against brute force,
#: and the chain against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents to deduplicated, decontaminated token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. Executors and their Python workers go from stage to stage and keep
the memory that the largest took, so every stage sets the session to small batches. These settings stay,
because the caller writes a stage's frame after it has returned; they change no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystream.llm.common import small_batches, stored, table, vocabulary
from tallystream.llm.decontaminate import drop_contaminated
from tallystream.llm.exact_dedup import drop_exact_copies
from tallystream.llm.jaccard_join import drop_near_copies
from tallystream.llm.language_id import keep_identified
from tallystream.llm.piece_codec import piece_digests


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; without letters there is none."""
    small_batches(spark)
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of largest doc_id."""
    small_batches(spark)
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of smallest doc_id."""
    small_batches(spark)
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    small_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids, and of the texts decoded from them.

    Workers go on to other stages with what they remember, so it is less here.
    """
    small_batches(spark)
    return piece_digests(docs, vocabulary("piece_bpe_32k.model"), kept=40_000)


STAGES = [
    ("language ID", identify),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]

#: The last stage's ids can't be had from SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

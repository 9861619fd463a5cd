"""What several operators of this subpackage need."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallystream.session import fresh_dir

#: Texts are worked on in portions of about this many characters, so that the words of one
#: portion, not of a whole Arrow batch, are in memory at once.
PORTION_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine that has the package."""
    return public_tokenizers.path(name)


#: Rows go to Python, and are read from files, in batches that are bounded in bytes, not only in rows: texts
#: may be long, and each task holds a few batches.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "6m",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def small_batches(spark: SparkSession) -> None:
    """Settings for tables of texts, from now on; a frame is run under those that hold when it is written."""
    for name, value in SMALL_BATCHES.items():
        spark.conf.set(name, value)


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write once into the shared folder and read again: lineage is cut and files can be located.

    ``by`` are columns that name folders, so that a filter on them reads its folders only.
    """
    where = fresh_dir(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(where) if by else df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def portions[S: (str, bytes)](texts: Sequence[S], chars: int = PORTION_CHARS) -> Iterator[list[S]]:
    """Consecutive texts of about ``chars`` characters (or bytes) together; a longer text is a portion alone."""
    some: list[S] = []
    held = 0
    for text in texts:
        if some and held + len(text) > chars:
            yield some
            some, held = [], 0
        some.append(text)
        held += len(text)
    if some:
        yield some


#: Longer words are rarely seen again, and would hold unbounded memory.
REMEMBERED_LENGTH = 64


class Memo(dict):
    """Results by word, filled by ``work`` and emptied when ``most`` are held; long words pass through."""

    def __init__(self, work: Callable[[str], object], most: int = 400_000):
        super().__init__()
        self._work = work
        self._most = most

    def __missing__(self, word: str):
        found = self._work(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= self._most:
                self.clear()
            self[word] = found
        return found


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])

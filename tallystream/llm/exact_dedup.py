"""Exact deduplication with keyed streaming state.

A Structured Streaming query groups signatures of documents by digest. Its state, on the
executors' disks with a change log in the shared folder, never expires; it holds per digest the
largest document id, where that document's text is stored (file and row) and how many rows have
the digest. Everything a run needs lies under its checkpoint: the signatures that the query reads, its
state, and the groups that each batch changed. A later run over the same checkpoint adds the signatures of
files that have none yet and goes on from that state, also after a run that died; it gives the groups
of all documents so far, as one run over all of them would.

A digest seen more than once is a hit. For every hit the full texts are compared, those of earlier
runs fetched by their files and rows; should two different texts share a digest, the rows of that digest
are grouped anew by their texts. All of it is DataFrame code; texts move only for hits, and a
group of copies is combined before it moves.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallystream.llm.common import SMALL_BATCHES, stored, text_or_empty
from tallystream.operators.joins import lookup_join
from tallystream.session import fresh_dir

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    # A store's memory goes when its task ends; the next batch, if any, opens it again.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # Many small stores: no space is set aside for files that stay short.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
SHA_BYTES = 32


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def with_places(documents: DataFrame) -> DataFrame:
    """The documents, read from files: as they are where their rows have a place, else written first."""
    try:
        documents.select("_metadata.file_path", "_metadata.row_index")
        return documents
    except AnalysisException:
        return stored(documents, "located")


def located(documents: DataFrame) -> DataFrame:
    """doc_id and text with the place of each row; rows that have none are written to files first."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    wanted = [F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")]
    documents.select(*wanted)  # a missing column is an error of its own
    return with_places(documents.select("doc_id", "text")).select(*wanted, *place)


def _held(spark: SparkSession, folder: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # Rows from the driver's lists would start Python workers on the executors, which nothing else here needs.
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def add_signatures(documents: DataFrame, folder: str) -> tuple[DataFrame, bool]:
    """Signatures of the documents' files that have none in the folder are added; returns all of them, and
    whether some were there before.

    Signatures are short, so they are packed into few files: each costs requests, or helper processes on a
    plain file system, and is listed by the streaming query. Those of one file stay together unless they
    are many.
    """
    spark = documents.sparkSession
    new = signatures(documents)
    known = stored(_held(spark, folder, new.schema).select("file").distinct(), "signed-files")
    earlier = not known.isEmpty()
    if earlier:
        new = lookup_join(new, known, ["file"], "left_anti")
    new.hint("rebalance", "file").write.mode("append").parquet(folder)
    return spark.read.schema(new.schema).parquet(folder), earlier


def signatures(places: DataFrame) -> DataFrame:
    return places.select("doc_id", "file", "row", F.unhex(F.sha2("text", 256)).alias("sha"))


def digest_groups(
    spark: SparkSession, folder: str, schema, checkpoint: str, key: Column, files_per_batch: int | None = None
) -> DataFrame:
    """State per digest after all signature files in ``folder``: digest, keep (id and place), n.

    A batch that is run again after a crash overwrites what it wrote.
    """
    out = f"{checkpoint}/groups"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    groups = (
        reader.parquet(folder)
        .groupBy(key.alias("digest"))
        .agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
    )
    with _settings(spark, STATE_SETTINGS):
        running = (
            groups.writeStream.outputMode("update")
            .option("checkpointLocation", f"{checkpoint}/state")
            .trigger(availableNow=True)
            .foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
            .start()
        )
        running.awaitTermination()
    # Every batch wrote the groups it changed; both values only grow.
    return (
        _held(spark, out, groups.schema)
        .groupBy("digest")
        .agg(F.max("keep").alias("keep"), F.max("n").alias("n"))
    )


def _mixed_digests(places: DataFrame, groups: DataFrame, key: Column) -> DataFrame:
    """Hit digests under which the full texts are not all the same."""
    hits = groups.where("n > 1").select("digest")
    texts = places.withColumn("sha", F.unhex(F.sha2("text", 256))).select(key.alias("digest"), "text")
    of_hits = lookup_join(texts, hits, ["digest"], "left_semi")
    return of_hits.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select("digest")


def _with_earlier(places: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents, and those of files of earlier runs in which a hit stands, read by their places.

    The driver gets names of files only, which it lists for any scan.
    """
    spark = places.sparkSession
    now = stored(places.select("file").distinct(), "files")
    before = lookup_join(members, now, ["file"], "left_anti")
    hits = lookup_join(before, groups.where("n > 1").select("digest"), ["digest"], "left_semi")
    files = [r.file for r in hits.select("file").distinct().collect()]
    if not files:
        return places
    wanted = [F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")]
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    return places.unionByName(spark.read.option("mergeSchema", "true").parquet(*files).select(*wanted, *place))


def exact_groups(
    documents: DataFrame,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
    key_bytes: int = SHA_BYTES,
) -> DataFrame:
    """One row per document: doc_id, file, row, keep_id, group_size, kept, text_sha256.

    With a ``checkpoint``, a folder of its own, rows are those of all runs over it, and documents of files
    that an earlier run signed are not counted again; ``key_bytes`` has to stay the same, and the files
    have to stay where they are. A frame that isn't read from files is written to new ones each time.
    Texts are equal when all their bytes are; null counts as the empty text, so nulls and empty
    texts are one group. The row with the largest ``doc_id`` stays, of several such rows the one
    stored last; a null id is smaller than any other. Only ``doc_id`` and ``text`` are read.
    ``key_bytes`` shortens the digest that state is keyed by.
    """
    spark = documents.sparkSession
    places = located(documents)
    checkpoint = checkpoint or fresh_dir(spark, "exact-dedup")
    folder = f"{checkpoint}/signatures"
    key = F.substring("sha", 1, key_bytes) if key_bytes < SHA_BYTES else F.col("sha")
    with _settings(spark, SMALL_BATCHES):
        signed, earlier = add_signatures(places, folder)
        groups = digest_groups(spark, folder, signed.schema, checkpoint, key, files_per_batch)
        members = signed.withColumn("digest", key)
        if earlier:
            places = _with_earlier(places, members, groups)
        mixed = _mixed_digests(places, groups, key)
        agree = mixed.isEmpty()
    result = _describe(members.join(groups, "digest"))
    if agree:
        return result
    by_text = places.withColumn("sha", F.unhex(F.sha2("text", 256))).withColumn("digest", key)
    apart = lookup_join(by_text, mixed, ["digest"], "left_semi")
    texts = apart.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    clean = groups.join(mixed, "digest", "left_anti")
    return _describe(members.join(clean, "digest")).unionByName(_describe(apart.join(texts, ["digest", "text"])))


def _describe(rows: DataFrame) -> DataFrame:
    stays = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    return rows.select(
        "doc_id",
        "file",
        "row",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        stays.alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(documents: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns, of each text the one with the largest doc_id.

    Nulls count as empty texts, which are one group; of rows with equal ids the one stored last stays. An
    empty table stays empty. A frame that isn't read from files is written first.
    """
    documents = with_places(documents)
    dropped = exact_groups(documents).where(~F.col("kept")).select("file", "row")
    whole = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    return lookup_join(whole, dropped, ["file", "row"], "left_anti").select("whole.*")

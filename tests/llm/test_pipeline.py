import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import cases as C


def _by_hand(rows, items):
    """What the stages keep, worked out one document after the other."""
    kept = [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    kept = [(d, t) for d, t in kept if d == max(x for x, u in kept if u == t)]
    groups = C.near_groups(kept)
    kept = [r for r, g in zip(kept, groups) if r[0] == g[1]]
    dirty = {r[0] for r in C.contaminated(kept, items) if r[5]}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for d, t in kept:
        if d not in dirty:
            ids = [1, *library.encode(t), 2]
            digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            out.append((d, len(ids), digest, C.sha(library.decode(ids))))
    return out


def _write(spark, folder, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")}
    )
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_against_a_plain_version(spark, tmp_path):
    rows = [(d, t) for d, t in dict(r for r in C.DOCUMENTS if r[0] is not None).items()]
    _write(spark, str(tmp_path), rows, C.BENCHMARK)
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert C.rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == C.sorted_rows(_by_hand(rows, C.BENCHMARK))


def test_every_stage_sends_long_texts_in_small_batches(spark, tmp_path):
    _write(spark, str(tmp_path), C.DOCUMENTS, C.BENCHMARK)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    long_rows = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("x"), F.lit(10_000)).alias("text"))
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name) for name in names}

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            for setting in names:
                spark.conf.unset(setting)
            stage(spark, docs, str(tmp_path))
            assert max(r.size for r in long_rows.mapInArrow(sizes, "size long").collect()) < 7_000_000, name
            assert int(spark.conf.get(names[1])) <= 512, name
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    _write(spark, str(tmp_path / "some"), C.DOCUMENTS, C.BENCHMARK)
    _write(spark, str(tmp_path / "none"), [], [])
    for folder in ("some", "none"):
        docs = spark.read.parquet(f"{tmp_path}/{folder}/documents.parquet")
        for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = stage(spark, docs, f"{tmp_path}/{folder}")
            assert out.columns == docs.columns, name
            out.write.parquet(f"{tmp_path}/{folder}-{n}")
            docs = spark.read.parquet(f"{tmp_path}/{folder}-{n}")
        assert corpus_pipeline.STAGES[-1][1](spark, docs, f"{tmp_path}/{folder}").count() == docs.count()
        assert (docs.count() > 0) == (folder == "some")

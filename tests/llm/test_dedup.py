import pytest
from pyspark.sql import functions as F

from tallystream.llm.components import connected_components
from tallystream.llm.exact_dedup import drop_exact_copies, exact_groups
from tallystream.llm.jaccard_join import alike, drop_near_copies, least_agreements, likely_pairs, near_groups
from tallystream.llm.substring_dedup import remove_repeats
from tallystream.llm.wordhash import Words, pieces
from tests.llm import cases as C


@pytest.mark.parametrize("key_bytes,files", [(32, None), (32, 1), (0, None), (1, 1)])
def test_exact_groups_with_shortened_digests_and_batches(spark, key_bytes, files):
    rows = C.DOCUMENTS
    found = exact_groups(C.documents(spark), key_bytes=key_bytes, files_per_batch=files)
    order = lambda d: -(2**63) if d is None else d
    want = []
    for d, t in rows:
        same = [x for x, u in rows if (u or "") == (t or "")]
        want.append((d, max(same, key=order), len(same), C.sha(t or "")))
    assert C.rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == C.sorted_rows(want)
    kept = found.where("kept")
    assert kept.count() == len({t or "" for _, t in rows})
    assert kept.where("not (doc_id <=> keep_id)").count() == 0


def test_exact_state_goes_on_from_its_checkpoint(spark, tmp_path):
    checkpoint, out = f"{tmp_path}/state", []
    from tallystream.llm.exact_dedup import digest_groups, located, signatures

    folder = f"{tmp_path}/signatures"
    for part in (C.DOCUMENTS[:10], C.DOCUMENTS[10:]):
        signed = signatures(located(C.documents(spark, part)))
        signed.write.mode("append").parquet(folder)
        out.append(digest_groups(spark, folder, signed.schema, checkpoint, F.col("sha")))
    base = out[1].where(F.col("digest") == F.unhex(F.lit(C.sha(C.BASE)))).first()
    assert (base.keep.doc_id, base.n) == (20, 5)


def files_of(spark, path, *tables):
    """Tables read from files of their own."""
    for n, rows in enumerate(tables):
        C.documents(spark, rows).write.parquet(f"{path}/d{n}")
    return [spark.read.parquet(f"{path}/d{n}") for n in range(len(tables))]


GROUPS = ("doc_id", "file", "row", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("key_bytes", [32, 1, 0])
def test_two_runs_over_one_checkpoint_equal_one_over_both_tables(spark, tmp_path, key_bytes):
    more = C.DOCUMENTS[::2] + [(90, "new"), (91, "new"), (92, C.BASE + " other")]
    first, second = files_of(spark, tmp_path, C.DOCUMENTS, more)
    checkpoint = f"{tmp_path}/checkpoint"
    exact_groups(first, checkpoint, key_bytes=key_bytes).count()
    twice = C.rows_of(exact_groups(second, checkpoint, key_bytes=key_bytes), *GROUPS)
    both = spark.read.parquet(f"{tmp_path}/d0", f"{tmp_path}/d1")
    once = C.rows_of(exact_groups(both, key_bytes=key_bytes), *GROUPS)
    assert twice == once and len(twice) == len(C.DOCUMENTS) + len(more)
    # Run again, over files that have been seen.
    assert C.rows_of(exact_groups(second, checkpoint, key_bytes=key_bytes), *GROUPS) == once
    assert C.rows_of(exact_groups(first, checkpoint, key_bytes=key_bytes), *GROUPS) == once


def test_signatures_of_many_files_lie_in_few(spark, tmp_path):
    import os

    from tallystream.llm.exact_dedup import SMALL_BATCHES, _held

    C.documents(spark).repartition(12).write.parquet(f"{tmp_path}/many")
    docs = spark.read.parquet(f"{tmp_path}/many")
    before = [spark.conf.get(name) for name in SMALL_BATCHES]
    groups = exact_groups(docs, f"{tmp_path}/checkpoint")
    assert groups.where("kept").count() == len({t or "" for _, t in C.DOCUMENTS})
    parts = lambda path: sum(f.endswith(".parquet") for f in os.listdir(path))
    assert parts(f"{tmp_path}/many") == 12 and parts(f"{tmp_path}/checkpoint/signatures") < 4
    assert [spark.conf.get(name) for name in SMALL_BATCHES] == before
    # Nothing held yet: no rows, and none made in Python workers.
    empty = _held(spark, f"{tmp_path}/none", groups.schema)
    assert empty.count() == 0 and [f.dataType for f in empty.schema] == [f.dataType for f in groups.schema]
    assert "ExistingRDD" not in empty._jdf.queryExecution().toString()


def test_a_run_that_died_goes_on(spark, tmp_path, monkeypatch):
    import tallystream.llm.exact_dedup as E

    (docs,) = files_of(spark, tmp_path, C.DOCUMENTS)
    checkpoint = f"{tmp_path}/checkpoint"

    def die(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(E, "_mixed_digests", die)  # after the batches were committed
        with pytest.raises(RuntimeError):
            exact_groups(docs, checkpoint, files_per_batch=1)
    assert C.rows_of(exact_groups(docs, checkpoint), *GROUPS) == C.rows_of(exact_groups(docs), *GROUPS)


def test_copies_of_a_frame_without_files(spark):
    docs = C.documents(spark)
    left = drop_exact_copies(docs.withColumn("extra", F.lit(1)))
    assert left.columns == [*docs.columns, "extra"] and left.count() == len({t or "" for _, t in C.DOCUMENTS})
    with pytest.raises(Exception, match="doc_id"):
        exact_groups(docs.drop("doc_id"))


def test_drop_exact_copies_keeps_columns(spark, tmp_path):
    C.documents(spark).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({t or "" for _, t in C.DOCUMENTS})


@pytest.mark.parametrize("sizes", [{}, {"bucket_bytes": 1000}, {"bucket_windows": 5, "bucket_bytes": 10**9}])
def test_remove_repeats_against_all_windows(spark, sizes):
    found = remove_repeats(C.documents(spark), **sizes)
    assert C.rows_of(found, "doc_id", "n_words", "n_removed", "kept_text") == C.sorted_rows(C.without_repeats(C.DOCUMENTS))


@pytest.mark.parametrize("ids", [(None, None), (7, 7), (None, 7)])
def test_texts_of_one_id_and_equal_checksums(spark, ids):
    import zlib

    # Two texts of one CRC-32.
    first, base = C.prose(21, 40) + " end", C.prose(22, 60) + " "
    found = base + "bmaddaanki"
    assert zlib.crc32(found.encode()) == zlib.crc32(first.encode())
    rows = [(0, " ".join(first.split()[5:30])), (1, " ".join(base.split()[20:50])), (ids[0], first), (ids[1], found)]
    got = remove_repeats(C.documents(spark, rows))
    assert C.rows_of(got, "doc_id", "n_words", "n_removed", "kept_text") == C.sorted_rows(C.without_repeats(rows))


def test_a_passage_inside_other_text_goes_once(spark):
    passage = C.prose(9, 60)
    rows = [(i, f"{C.prose(100 + i, 20, 10**9)} {passage} {C.prose(200 + i, 20, 10**9)}") for i in range(40)]
    found = remove_repeats(C.documents(spark, rows), bucket_bytes=2000)
    assert C.rows_of(found, "doc_id", "n_words", "n_removed", "kept_text") == C.sorted_rows(C.without_repeats(rows))
    assert {r[2] for r in C.rows_of(found, "doc_id", "n_words", "n_removed") if r[0]} == {60}


def test_long_texts_in_pieces_have_the_same_windows(monkeypatch):
    import tallystream.llm.wordhash as W

    monkeypatch.setattr(W, "PORTION_BYTES", 500)
    text = C.prose(5, 3000).encode()
    whole = Words([text])
    want = whole.window_hashes(13)[whole.window_starts(13)].tolist()
    got, places = [], []
    for piece, before in pieces(text, 13):
        w = Words([piece])
        at = w.window_starts(13)
        got += w.window_hashes(13)[at].tolist()
        places += (at + before).tolist()
    assert got == want and places == list(range(len(want)))


def test_near_groups_against_all_pairs(spark):
    found = near_groups(C.documents(spark))
    want = C.near_groups(C.DOCUMENTS)
    assert C.rows_of(found, "doc_id", "class_id", "n_links", "n_copies") == C.sorted_rows(want)


def test_a_large_group_is_compared_in_blocks(spark, monkeypatch):
    import tallystream.llm.jaccard_join as J

    monkeypatch.setattr(J, "BLOCK", 7)
    monkeypatch.setattr(J, "TOGETHER", 3)
    rows = [(i, C.near(1000 + i)) for i in range(45)] + [(100 + i, C.prose(300 + i // 2, 50)) for i in range(10)]
    found = near_groups(C.documents(spark, rows))
    assert C.rows_of(found, "doc_id", "class_id", "n_links", "n_copies") == C.sorted_rows(C.near_groups(rows))


def test_a_neighbourhood_is_shingled_in_portions(monkeypatch):
    import numpy as np

    import tallystream.llm.jaccard_join as J

    texts = [J.normal_words(C.near(1000 + i)) for i in range(40)] + [b"", b"two words"]
    keys = [b"%03d" % i for i in range(len(texts))]
    numbers = (np.arange(len(texts)) % 3 + 1, np.arange(len(texts)) % 2)
    want = J._compare(keys, *numbers, texts)
    held, whole = [], J.shingles
    monkeypatch.setattr(J, "shingles", lambda some: held.append(sum(map(len, some))) or whole(some))
    monkeypatch.setattr(J, "TEXT_BYTES", 2000)
    assert J._compare(keys, *numbers, texts) == want
    assert len(held) > 1 and max(held) <= 2000


def test_powers_are_kept_for_what_was_seen():
    from tallystream.llm.wordhash import _Powers

    powers, longer = _Powers(), _Powers()
    assert len(powers.to(1000)[0]) < 1 << 20
    for a, b in zip(powers.to(300_000), longer.to(1_000_000)):
        assert 300_000 <= len(a) < len(b) and (a == b[: len(a)]).all()


def test_drop_near_copies_keeps_one_of_each_group(spark):
    docs = C.documents(spark, [r for r in C.DOCUMENTS if r != (20, C.BASE)])
    left = drop_near_copies(docs)
    ids = [r[0] for r in C.rows_of(left, "doc_id")]
    assert left.columns == docs.columns
    assert 0 in ids and not {5, 6, 7, 9} & set(ids)
    assert {1, 2, 3, 10, 11, 12, 13} <= set(ids)


def test_pruning_spares_pairs_at_the_threshold():
    least = least_agreements()
    assert least[0] == 0 and all(a <= b for a, b in zip(least, least[1:]))
    assert 100 < least[240] < 0.8 * 240
    import numpy as np

    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (50, 240), dtype=np.uint16)
    b = rng.integers(0, 1 << 16, (50, 240), dtype=np.uint16)
    b[:25] = np.where(rng.random((25, 240)) < 0.82, a[:25], b[:25])
    i, j = likely_pairs(a, b, False)
    assert sorted(zip(i.tolist(), j.tolist())) == [(n, n) for n in range(25)]


def test_counting_by_matrix_and_by_pair_agree():
    import numpy as np

    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(30)]
    i, j = map(np.array, zip(*[(p, q) for p in range(30) for q in range(30)]))
    many = alike(i, j, sets, sets)
    one = np.concatenate([alike(i[n : n + 1], j[n : n + 1], sets, sets) for n in range(len(i))])
    assert (many == one).all() and many.any() and not many.all()


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (100, 102), (7, 7), (200, 201), (201, 200)]
    found = connected_components(spark.createDataFrame(edges, "u long, v long"))
    want = [(i, 1) for i in range(1, 41)] + [(i, 100) for i in (100, 101, 102)] + [(200, 200), (201, 200)]
    assert C.rows_of(found, "node", "root") == C.sorted_rows(want)


@pytest.mark.parametrize("operator", [exact_groups, remove_repeats, near_groups])
def test_empty_tables(spark, operator):
    assert operator(C.documents(spark, [])).count() == 0
    assert operator(C.documents(spark, [(1, None), (None, None)])).count() == 2

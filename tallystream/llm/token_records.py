"""Token ids as length-delimited binary records with a separate offset index.

A file holds records one after the other; a record is

    length       8 bytes, unsigned little-endian, of the payload
    check        4 bytes, masked checksum of the length's bytes
    payload      1 byte flags (1: there is a document id), 8 bytes signed document id,
                 1 byte width of an id (2 or 4), then the ids, little-endian
    check        4 bytes, masked checksum of the payload

The checksum is CRC-32, turned right by 15 bits and shifted by a constant, so that checksums of
data that hold checksums stay sound. The index, a Parquet table, has a row per record: file,
offset, size, document id, ids before it in the file, ids. Any row leads to its record with one
ranged read, so a shuffled reader needs no scan.

Each task writes a file of its own: under a name of its attempt first, moved to its final name
when complete. A repeated attempt writes the same bytes.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from tallystream.llm.common import REMEMBERED_LENGTH, fields, portions, stored, text_or_empty
from tallystream.session import fresh_dir

_LENGTH, _CHECK, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BqB")
_FRAME = _LENGTH.size + 2 * _CHECK.size
#: Bytes of neighbouring records that a reader fetches at once.
READ_BYTES = 8 << 20

INDEX = fields(
    ("part", T.IntegerType()),
    ("doc_id", T.LongType()),
    ("offset", T.LongType()),
    ("size", T.LongType()),
    ("ids_before", T.LongType()),
    ("n_tokens", T.LongType()),
)
RECORDS = fields(
    ("part", T.IntegerType()),
    ("doc_id", T.LongType()),
    ("ids_before", T.LongType()),
    ("n_tokens", T.LongType()),
    ("ids", T.BinaryType()),
)
READ = fields(
    ("part", T.IntegerType()),
    ("doc_id", T.LongType()),
    ("ids_before", T.LongType()),
    ("n_tokens", T.LongType()),
    ("ids_crc32", T.LongType()),
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))))


def unframe(record: bytes) -> bytes:
    """Payload of one whole record; raises where a length or checksum is wrong."""
    length = record[: _LENGTH.size]
    if len(record) < _FRAME or _CHECK.unpack_from(record, _LENGTH.size)[0] != masked(length):
        raise ValueError("damaged record length")
    size = _LENGTH.unpack(length)[0]
    payload = record[_LENGTH.size + _CHECK.size : -_CHECK.size]
    if size != len(payload) or _CHECK.unpack(record[-_CHECK.size :])[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


def pack_sequence(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(doc_id is not None, doc_id or 0, width) + ids


def unpack_sequence(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, doc_id, width = _HEAD.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=_HEAD.size)


# White space as the tokenizer's pattern takes it: ASCII, and other blocks.
_ASCII_WS, _OTHER_WS = "\t-\r ", "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ASCII_LOOSE = tuple(" " + c for c in "\t\n\x0b\x0c\r")
_HAS_OTHER_WS = re.compile(f"[{_OTHER_WS}]")
_BOUNDARY = re.compile(f" (?=[^{_ASCII_WS}{_OTHER_WS}])")
#: Characters whose class in the tokenizer's pattern is certain, whatever its version of Unicode.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_MARKS = "!-/:-@\\[-`{-~\xa1\xa7\xab\xb7\xbb\xbf\u2010-\u2027"
_PRE_TOKENS = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|[{_ASCII_WS}]+(?![^{_ASCII_WS}])|[{_ASCII_WS}]+"
)
#: Words that go to the library as one text.
WORDS_TOGETHER = 2000
#: Characters of the texts whose words are looked up together: more find more of their words in one look.
TEXTS_TOGETHER = 4 << 20


class Recent:
    """Results by word in two generations, at most about ``most`` in all.

    When the younger is full it becomes the older, which goes; what is asked for again moves back.
    """

    def __init__(self, most: int):
        self.young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._most = most

    def make_room(self) -> None:
        if len(self.young) > self._most // 2:
            self._old, self.young = self.young, {}

    def unknown(self, words: set[str]) -> set[str]:
        left = words.difference(self.young)
        new = left.difference(self._old)
        back = left - new
        self.young.update(zip(back, map(self._old.__getitem__, back)))
        return new


class ByteLevelEncoder:
    """Ids of a byte-level tokenizer, by words and their pre-tokens.

    Its pattern always starts a new pre-token at a space that is followed by no white space, so
    the stretches between such spaces encode independently. So do pre-tokens, into which a stretch
    of well-known characters is cut here, so that a word is learned once whatever marks surround it.
    What isn't remembered goes to the library, many in one text: a token that begins with a space begins a
    stretch, and a line break between others is a token of its own. Texts with special strings go there whole.
    """

    def __init__(self, path: str, kept: int = 1_600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._starts_word = np.zeros(self._tokenizer.get_vocab_size(), bool)
        space, line = (self._tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in " \n")
        self._starts_word[[n for token, n in self._tokenizer.get_vocab().items() if token.startswith(space)]] = True
        self._line = self._tokenizer.token_to_id(line)
        self._spaced = Recent(kept)
        self._bare = Recent(kept // 4)

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _alone(self, text: str) -> bytes:
        return self.pack(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _encode(self, some: list[list[str]], between: str) -> Iterator[np.ndarray]:
        texts = [between + between.join(words) for words in some]
        for found in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(found.ids)

    def _learn_spaced(self, stretches: set[str]) -> None:
        """Ids of stretches after a space."""
        odd = [w for w in stretches if " " in w]
        words = list(stretches.difference(odd))
        groups = [words[lo : lo + WORDS_TOGETHER] for lo in range(0, len(words), WORDS_TOGETHER)]
        for some, ids in zip(groups, self._encode(groups, " ")):
            starts = np.flatnonzero(self._starts_word[ids])
            if len(starts) != len(some):
                odd += some
                continue
            packed, ends = self.pack(ids), (starts * self.width).tolist()
            ends.append(len(packed))
            self._spaced.young.update((w, packed[a:b]) for w, a, b in zip(some, ends, ends[1:]))
        for word in odd:
            self._spaced.young[word] = self._alone(" " + word)

    def _learn_bare(self, parts: set[str]) -> None:
        """Ids of pre-tokens without a space before."""
        odd = [p for p in parts if p.isspace()]
        pieces = list(parts.difference(odd))
        groups = [pieces[lo : lo + WORDS_TOGETHER] for lo in range(0, len(pieces), WORDS_TOGETHER)]
        for some, ids in zip(groups, self._encode(groups, "\n")):
            lines = np.flatnonzero(ids == self._line)
            if len(lines) != len(some):
                odd += some
                continue
            packed, ends = self.pack(ids), (lines * self.width).tolist()
            ends.append(len(packed))
            self._bare.young.update((p, packed[a + self.width : b]) for p, a, b in zip(some, ends, ends[1:]))
        for piece in odd:
            self._bare.young[piece] = self._alone(piece)

    def _learn(self, words: set[str], heads: set[str]) -> list[tuple[dict, str]]:
        """Makes ids of all words after a space, and of heads, known; returns what is not to be remembered."""
        spaced, bare = self._spaced, self._bare
        whole: set[str] = set()
        cut: list[tuple[str, list[str]]] = []
        for word in spaced.unknown(words):
            found = [] if word.isalpha() and word.isascii() else _PRE_TOKENS.findall(" " + word)
            if len(found) < 2 or sum(map(len, found)) <= len(word):
                whole.add(word)
            else:
                cut.append((word, found))
        odd: list[str] = []
        starts: list[tuple[str, list[str]]] = []
        for head in bare.unknown(heads):
            found = _PRE_TOKENS.findall(head)
            if sum(map(len, found)) < len(head):
                odd.append(head)
            else:
                starts.append((head, found))
        pieces = {piece for _, found in cut for piece in found[1:]}.union(*[found for _, found in starts])
        stems = whole | spaced.unknown({found[0][1:] for _, found in cut})
        parts = bare.unknown(pieces)
        self._learn_spaced(stems)
        self._learn_bare(parts)
        for head in odd:
            bare.young[head] = self._alone(head)
        known, short = spaced.young, bare.young
        for word, found in cut:
            if len(found) == 2:
                known[word] = known[found[0][1:]] + short[found[1]]
            else:
                known[word] = known[found[0][1:]] + b"".join([short[p] for p in found[1:]])
        for head, found in starts:
            short[head] = b"".join([short[p] for p in found])
        long = [(known, w) for some in (words, stems) for w in some if len(w) > REMEMBERED_LENGTH]
        return long + [(short, p) for some in (heads, parts) for p in some if len(p) > REMEMBERED_LENGTH]

    @staticmethod
    def _split(text: str) -> list[str]:
        words = text.split(" ")
        if "" in words or any(p in text for p in _ASCII_LOOSE) or not text.isascii() and _HAS_OTHER_WS.search(text):
            return _BOUNDARY.split(text)
        return words

    def encode_all(self, texts: list[str]) -> list[bytes]:
        # Many short-lived lists and no cycles: the collector would walk them again and again for nothing.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode_all(texts)
        finally:
            if collects:
                gc.enable()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        self._spaced.make_room()
        self._bare.make_room()
        whole: dict[int, bytes] = {}
        heads: list[str] = []
        words: list[str] = []
        ends = [0]
        for n, text in enumerate(texts):
            if any(s in text for s in self._special):
                whole[n] = self._alone(text)
                heads.append("")
            else:
                split = self._split(text)
                heads.append(split[0])
                words += split[1:]
            ends.append(len(words))
        spaced, bare = self._spaced.young, self._bare.young
        passing = self._learn(set(words).difference(spaced), set(filter(None, heads)))
        ids = list(map(spaced.__getitem__, words))
        result = [
            whole[n] if n in whole else (bare[head] if head else b"") + b"".join(ids[ends[n] : ends[n + 1]])
            for n, head in enumerate(heads)
        ]
        for held, word in passing:
            held.pop(word, None)
        return result


@lru_cache(maxsize=2)
def _encoder(path: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(path)


def _file(folder: str, part: int) -> tuple[arrow_fs.FileSystem, str]:
    system, path = arrow_fs.FileSystem.from_uri(f"{folder}/part-{part:06d}.records")
    return system, path


def write_records(documents: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Write the sequences of all rows in ascending order of doc_id; returns the stored index.

    Files follow each other as their rows' ids do. Null ids come first, rows of equal id in the
    order of their texts. A null text is empty: its sequence is the end id alone. ``folder`` must
    be reachable from all executors.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = encoder.pack([end_id])
        part = TaskContext.get().partitionId()
        system, path = _file(folder, part)
        attempt = f"{path}.{uuid.uuid4().hex}"
        out, offset, before = None, 0, 0
        for batch in batches:
            if out is None:
                system.create_dir(path.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(attempt, buffer_size=1 << 20)
            doc_ids, rows = batch.column(0).to_pylist(), []
            at = 0
            for some in portions(batch.column(1).to_pylist(), TEXTS_TOGETHER):
                for ids in encoder.encode_all(some):
                    record = frame(pack_sequence(doc_ids[at], ids + end, encoder.width))
                    out.write(record)
                    n = len(ids) // encoder.width + 1
                    rows.append((part, doc_ids[at], offset, len(record), before, n))
                    offset, before, at = offset + len(record), before + n, at + 1
            yield _batch(rows, INDEX)
        if out is not None:
            out.close()
            system.move(attempt, path)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return stored(dealt.mapInArrow(write, INDEX), "token-index")


_ARROW = {"integer": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    kinds = [_ARROW[f.dataType.simpleString().replace("bigint", "long").replace("int", "integer")] for f in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)


def _records(folder: str, batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, int]]:
    """Row number, record and ids before it, of index rows; neighbours are read together."""
    parts, offsets, sizes = (batch.column(n).to_pylist() for n in ("part", "offset", "size"))
    at = 0
    while at < len(parts):
        stop, size = at + 1, sizes[at]
        while (
            stop < len(parts)
            and parts[stop] == parts[at]
            and offsets[stop] == offsets[at] + size
            and size + sizes[stop] <= READ_BYTES
        ):
            size += sizes[stop]
            stop += 1
        system, path = _file(folder, parts[at])
        with system.open_input_file(path) as file:
            data = file.read_at(size, offsets[at])
        for row in range(at, stop):
            start = offsets[row] - offsets[at]
            yield row, data[start : start + sizes[row]]
        at = stop


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Sequences of any index rows, in whatever order the rows come; checksums are verified."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, before = batch.column("part").to_pylist(), batch.column("ids_before").to_pylist()
            rows, held = [], 0
            for row, record in _records(folder, batch):
                doc_id, ids = unpack_sequence(unframe(record))
                rows.append((parts[row], doc_id, before[row], len(ids), ids.astype("<u4").tobytes()))
                held += len(ids)
                if held > READ_BYTES:
                    yield _batch(rows, RECORDS)
                    rows, held = [], 0
            yield _batch(rows, RECORDS)

    return index.mapInArrow(read, RECORDS)


def read_digests(index: DataFrame, folder: str) -> DataFrame:
    """As ``read_records``, with the checksum of the ids in place of the ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, before = batch.column("part").to_pylist(), batch.column("ids_before").to_pylist()
            rows = []
            for row, record in _records(folder, batch):
                doc_id, ids = unpack_sequence(unframe(record))
                rows.append((parts[row], doc_id, before[row], len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            yield _batch(rows, READ)

    return index.mapInArrow(read, READ)


def file_starts(index: DataFrame) -> DataFrame:
    """Ids in all files before each file: one row per file, summed up on the driver."""
    sums = sorted((r.part, r.n) for r in index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts = accumulate((n for _, n in sums), initial=0)
    return index.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(sums, starts)], "part int, file_start long"
    )


def record_digests(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write all sequences into the shared folder, read them back and describe each.

    Per row: doc_id, start (ids of all sequences before it), n_tokens, ids_crc32. An empty table
    gives no files and no rows; columns other than doc_id and text are not read.
    """
    folder = fresh_dir(documents.sparkSession, "token-records")
    index = write_records(documents, tokenizer, end_id, folder)
    found = read_digests(index, folder).join(F.broadcast(file_starts(index)), "part")
    return found.select("doc_id", (F.col("file_start") + F.col("ids_before")).alias("start"), "n_tokens", "ids_crc32")

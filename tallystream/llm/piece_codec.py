"""SentencePiece encoding of merge-type models by backtracking, and decoding.

A merge-type model joins, again and again, the adjacent pair whose joined string is the best
piece. Its result is the one sequence of pieces in which every piece is reachable and every two
neighbours are *compatible*: joining up their two strings from characters gives the two again.
So the encoder walks forward with the longest piece at each position, checks it against its left
neighbour only, tries the next shorter one where they disagree, and goes back a piece where none
is left. A bit for each position from which no way leads on keeps it from being tried twice, so
the work is linear in the text.

Long texts are cut at places no piece reaches across (a character pair that occurs inside no
piece); the parts encode independently, and the results of frequent parts are kept.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tallystream.llm.common import Memo, fields, portions, text_or_empty

SPACE = "▁"
#: Kinds of entries in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: The decoder's picture of a byte token of 128 or more until bytes are put together.
_ESCAPE = 0xDC00
#: Error handler: a replacement character for each byte that belongs to none.
_EACH_BYTE = "tallystream.each_byte"
codecs.register_error(_EACH_BYTE, lambda e: ("\ufffd" * (e.end - e.start), e.end))

#: Words, and parts of words, whose ids a worker remembers.
KEPT = 500_000

RESULT = fields(
    ("n_tokens", T.LongType()),
    ("ids_sha256", T.StringType()),
    ("decoded_sha256", T.StringType()),
)


class MergeModel:
    """Pieces and scores of a model file.

    Models with a normalization table, user-defined symbols or other than the merge type are
    refused, because their texts take other ways.
    """

    def __init__(self, path: str):
        proto = model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules = proto.normalizer_spec
        if proto.trainer_spec.model_type != model_pb2.TrainerSpec.BPE:
            raise ValueError("not a merge-type model")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("models that rewrite their texts are not supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("space marks at word ends are not supported")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.names = [p.piece for p in proto.pieces]
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = self.begin = self.end = -1
        silent = []
        for n, p in enumerate(proto.pieces):
            if p.type == USER_DEFINED:
                raise ValueError("user-defined symbols are not supported")
            if p.type == NORMAL:
                self.ids[p.piece], self.score[p.piece] = n, p.score
            elif p.type == BYTE:
                self.bytes[n] = int(p.piece[3:5], 16)
            elif p.type == UNKNOWN:
                self.unknown = n
            else:
                silent.append(n)
                if p.piece == proto.trainer_spec.bos_piece:
                    self.begin = n
                if p.piece == proto.trainer_spec.eos_piece:
                    self.end = n
        self.silent = silent
        self.unknown_surface = proto.trainer_spec.unk_surface
        self.byte_ids = {value: n for n, value in self.bytes.items()}

    def merge(self, text: str) -> list[str]:
        """Join the best adjacent pair until none is a piece: the definition of the encoding."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class PieceEncoder:
    """Ids of texts under a merge-type model."""

    def __init__(self, path: str, kept: int = KEPT):
        self.model = model = MergeModel(path)
        automaton = ahocorasick.Automaton()
        for piece in model.ids:
            if len(piece) > 1 and model.merge(piece) == [piece]:  # others never come out of merging
                automaton.add_word(piece, piece)
        automaton.make_automaton()
        self._matches = automaton.iter
        self._fits = Memo(lambda pair: model.merge(pair[0] + pair[1]) == [*pair], 300_000)
        self._inside = {piece[i : i + 2] for piece in model.ids for i in range(len(piece) - 1)}
        #: No piece goes on with a space mark after another character, so words stand alone.
        self._words_apart = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self._inside)
        self._packed = Memo(self._pack, 100_000)
        self._part = Memo(self._encode_part, kept)
        self._word = Memo(self._encode_word, kept)
        self._spaced = Memo(lambda word: self._encode_word(SPACE + word), kept)

    def _pack(self, piece: str) -> bytes:
        number = self.model.ids.get(piece)
        if number is not None:
            return number.to_bytes(4, "little")
        if self.model.byte_ids:
            return b"".join(self.model.byte_ids[b].to_bytes(4, "little") for b in piece.encode())
        return self.model.unknown.to_bytes(4, "little")

    def pieces(self, text: str) -> list[str]:
        """The piece strings of one part, by backtracking."""
        size = len(text)
        if size < 2:
            return [text] if text else []
        choices: list[list[str]] = [[c] for c in text]
        for last, piece in self._matches(text):  # at one start the longer ones come later
            choices[last - len(piece) + 1].append(piece)
        fits, failed, at = self._fits, bytearray(size // 8 + 1), 0  # a bit for each position
        path: list[str] = []
        tries = [len(choices[0]) - 1]
        while True:
            options, k = choices[at], tries[-1]
            while k >= 0:
                piece = options[k]
                after = at + len(piece)
                if not failed[after >> 3] >> (after & 7) & 1 and (not path or fits[path[-1], piece]):
                    break
                k -= 1
            if k >= 0:
                tries[-1] = k
                path.append(piece)
                at = after
                if at == size:
                    return path
                tries.append(len(choices[at]) - 1)
            else:
                if not path:
                    raise ValueError("no sequence of pieces fits")
                tries.pop()
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(path.pop())
                tries[-1] -= 1

    def _encode_part(self, part: str) -> bytes:
        packed = list(map(self._packed.__getitem__, self.pieces(part)))
        if not self.model.byte_ids:  # unknown neighbours become one
            unknown = self.model.unknown.to_bytes(4, "little")
            packed = [p for i, p in enumerate(packed) if p != unknown or not i or packed[i - 1] != unknown]
        return b"".join(packed)

    def _encode_word(self, word: str) -> bytes:
        """A text cut wherever its two neighbouring characters are together in no piece."""
        if not self.model.byte_ids:
            return self._encode_part(word)
        inside, start, found = self._inside, 0, []
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in inside:
                found.append(self._part[word[start:i]])
                start = i
        if not start:
            return self._encode_part(word)
        found.append(self._part[word[start:]])
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end."""
        if not text:
            return b""
        if self._words_apart and self.model.prefix and SPACE not in text:
            words = text.split(" ")
            if "" not in words:
                return b"".join(map(self._spaced.__getitem__, words))
        marked = self.model.prefix + text.replace(" ", SPACE)
        if not self._words_apart:
            return self._encode_word(marked)
        # A run of spaces belongs to the word after it.
        words = re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", marked)
        return b"".join(map(self._word.__getitem__, words))


class PieceDecoder:
    """Texts of ids, as the library gives them back."""

    def __init__(self, path: str):
        model = MergeModel(path)
        self._model = model
        shown = [name.replace(SPACE, " ") for name in model.names]
        for n, value in model.bytes.items():
            shown[n] = chr(value) if value < 128 else chr(_ESCAPE + value)
        for n in model.silent:
            shown[n] = ""
        if model.unknown >= 0:
            shown[model.unknown] = model.unknown_surface
        self._shown = np.array(shown, dtype=object)
        self._silent = set(model.silent)
        self._plain = np.zeros(len(shown), bool)
        self._plain[[n for n in range(len(shown)) if n not in self._silent]] = True
        self._starts_with_space = {n for n, s in enumerate(shown) if s.startswith(" ") and n != model.unknown and n not in model.bytes}

    def decode(self, ids: np.ndarray) -> str:
        """Begin and end marks show nothing; the space put before the text goes again; byte
        tokens are read as UTF-8, with U+FFFD for a byte that belongs to no character."""
        text = "".join(self._shown[ids].tolist())
        if self._model.prefix:
            spoken = ids[self._plain[ids]]
            if len(spoken) and int(spoken[0]) in self._starts_with_space:
                text = text[1:]
        if text.isascii():
            return text
        return text.encode("utf-8", "surrogateescape").decode("utf-8", _EACH_BYTE)


@lru_cache(maxsize=4)
def _codec(path: str, kept: int = KEPT) -> tuple[PieceEncoder, PieceDecoder]:
    return PieceEncoder(path, kept), PieceDecoder(path)


def encode_pieces(text: Column, path: str) -> Column:
    """Ids of a text with begin and end, as binary of little-endian unsigned 32-bit integers.

    A null is read as the empty text, which has the two marks only.
    """

    @F.pandas_udf(T.BinaryType())
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder, _ = _codec(path)
        begin, end = (np.array([n], "<u4").tobytes() for n in (encoder.model.begin, encoder.model.end))
        for batch in batches:
            yield pd.Series([begin + encoder.encode(t or "") + end for t in batch.tolist()], dtype=object)

    return encode(F.coalesce(text, F.lit("")))


def decode_pieces(ids: Column, path: str) -> Column:
    """Text of binary ids; null for null."""

    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, decoder = _codec(path)
        for batch in batches:
            yield pd.Series(
                [None if b is None else decoder.decode(np.frombuffer(b, "<u4")) for b in batch.tolist()], dtype=object
            )

    return decode(ids)


def piece_digests(documents: DataFrame, path: str, kept: int = KEPT) -> DataFrame:
    """Per row: doc_id, number of ids, digest of the ids, digest of the text decoded from them.

    ``kept`` bounds what a worker remembers, at the price of encoding more words again. Null texts count as empty; every row of a repeated ``doc_id`` has its own result; other
    columns are not read.
    """

    @F.pandas_udf(RESULT)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, decoder = _codec(path, kept)
        begin, end = (np.array([n], "<u4").tobytes() for n in (encoder.model.begin, encoder.model.end))
        for batch in batches:
            rows = []
            for some in portions(batch.tolist()):
                for text in some:
                    ids = begin + encoder.encode(text) + end
                    decoded = decoder.decode(np.frombuffer(ids, "<u4"))
                    rows.append(
                        (
                            len(ids) // 4,
                            hashlib.sha256(ids).hexdigest(),
                            hashlib.sha256(decoded.encode()).hexdigest(),
                        )
                    )
            yield pd.DataFrame(rows, columns=RESULT.names)

    found = documents.select(F.col("doc_id"), digest(text_or_empty()).alias("r"))
    return found.select("doc_id", "r.*")

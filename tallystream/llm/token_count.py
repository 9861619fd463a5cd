"""Token counts without tokenizing what is known to be one token.

Offline, once and on the driver, every vocabulary string is tried alone: those that the tokenizer
gives back as a single token form the *whole-token* set. Counting then looks words up. A
pre-token of the set counts one; only the rest is merged, by the tokenizer itself, and remembered.

The pre-tokens of this vocabulary never hold white space, and normalization doesn't go across ASCII
white space, so a text's count is the sum over its words. Words that can't be split here as the
tokenizer does (control characters that the two libraries class differently, characters outside the
Latin blocks) are given to the tokenizer one by one, and texts with special strings whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from tallystream.llm.common import Memo, portions, text_or_empty

#: The parts of the tokenizer file that the shortcut has been shown for.
KNOWN_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
KNOWN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Characters of ASCII and the Latin blocks, whose classes all Unicode versions share; the
#: separators 1C-1F are white space to one library only.
_PLAIN = re.compile("[\x00-\x1b\x20-ɏ]*")
#: The split above for plain words: a letter is what is a word character, no number and no "_".
_NUMBERS = "0-9²³¹¼½¾"
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[^\\W{_NUMBERS}_]+|[{_NUMBERS}]|[\\W_]+")
#: Both libraries take these as white space; a word may hold more of it.
_WORD = re.compile("[^\t-\r ]+")


def tokenizer_of(path: str) -> Tokenizer:
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def shortcut_holds(path: str) -> bool:
    """Whether a tokenizer file normalizes and splits as the shortcut expects."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    normalizer, split = rules.get("normalizer") or {}, (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        normalizer.get("normalizers") == KNOWN_NORMALIZERS
        and len(split) == 2
        and split[0].get("pattern") == {"Regex": KNOWN_SPLIT}
        and (split[0].get("behavior"), split[0].get("invert")) == ("Removed", True)
        and (split[1].get("type"), split[1].get("use_regex"), split[1].get("add_prefix_space")) == ("ByteLevel", False, False)
    )


def whole_tokens(path: str) -> frozenset[str]:
    """Strings that are one pre-token and encode alone as one token; no more than the vocabulary."""
    tokenizer = tokenizer_of(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings = sorted(
        {
            word
            for entry in tokenizer.get_vocab()
            if entry not in special
            for word in [entry.removesuffix("</w>")]
            if word and word.isascii() and word == word.lower() and _SPLIT.findall(word) == [word]
        }
    )
    alone = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(word for word, found in zip(strings, alone) if len(found.ids) == 1)


class TokenCounter:
    def __init__(self, path: str, whole: frozenset[str], kept: int = 500_000):
        self._tokenizer = tokenizer_of(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._whole = whole
        self._shortcut = shortcut_holds(path)
        self._merged = Memo(self._merge, kept)
        self._word = Memo(self._count_word, kept)

    def _merge(self, pre_token: str) -> int:
        return len(self._tokenizer.encode(pre_token, add_special_tokens=False).ids)

    def _count_word(self, word: str) -> int:
        """Tokens of what stands between ASCII white space, as the tokenizer itself gives them."""
        if word in self._whole:
            return 1
        plain = word if unicodedata.is_normalized("NFC", word) else unicodedata.normalize("NFC", word)
        if _PLAIN.fullmatch(plain) is None:
            return self._merge(word)
        pre_tokens = (p for part in plain.lower().split() for p in _SPLIT.findall(part))
        return sum(1 if p in self._whole else self._merged[p] for p in pre_tokens)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self._shortcut or any(s in text for s in self._special):
            return self._merge(text)
        return sum(map(self._word.__getitem__, _WORD.findall(text)))


@lru_cache(maxsize=4)
def _counter(path: str, whole: frozenset[str]) -> TokenCounter:
    return TokenCounter(path, whole)


def count_tokens(documents: DataFrame, path: str, limit: int) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens; every row of a repeated ``doc_id`` is
    counted; other columns are not read. Special strings inside texts count as the tokenizer
    takes them by default, one token each.
    """
    known = documents.sparkSession.sparkContext.broadcast(whole_tokens(path))

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path, known.value)
        for batch in batches:
            yield pd.Series([counter.count(t) for some in portions(batch.tolist()) for t in some], dtype="int64")

    text = text_or_empty()
    found = documents.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("n_tokens"))
    return found.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))

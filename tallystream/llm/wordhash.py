"""Words of many texts at once, as arrays: packed strings, hashes, windows and their minimisers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text that are analysed together.
PORTION_BYTES = 2 << 20
#: Powers are kept for the longest portion so far, rounded up to this many.
_POWERS_BY = 1 << 18

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of the base and their inverses, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            size = -(-size // _POWERS_BY) * _POWERS_BY
            for name, base in (("up", int(_BASE)), ("down", _inverse(int(_BASE)))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


class Words:
    """Words of several texts side by side: packed with single spaces, with hashes and owners."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        is_word = _WORD[raw]
        edges = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        first = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.zeros(0, np.int64)
        self.owner = np.searchsorted(first, starts, side="right") - 1
        self.sizes = ends - starts
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        keep = is_word.copy()
        keep[ends[ends < len(raw)]] = True
        packed = raw[keep]
        packed[~is_word[keep]] = 0x20
        self.packed = packed.tobytes()
        up, down = _POWERS.to(len(packed) + 1)
        sums = np.zeros(len(packed) + 1, np.uint64)
        np.cumsum((packed.astype(np.uint64) + np.uint64(1)) * up[: len(packed)], out=sums[1:])
        self.hashes = mix((sums[self.starts + self.sizes] - sums[self.starts]) * down[self.starts])

    def window_starts(self, span: int) -> np.ndarray:
        """Words at which a whole window of one text begins."""
        if len(self.owner) < span:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.owner[: len(self.owner) - span + 1] == self.owner[span - 1 :])

    def window_hashes(self, span: int) -> np.ndarray:
        """Hash of the words from each word on; meaningful where a whole window begins."""
        n = len(self.hashes) - span + 1
        found = np.zeros(max(n, 0), np.uint64)
        for k in range(span if n > 0 else 0):
            found = found * _STEP + self.hashes[k : k + n]
        return mix(found)

    def minimisers(self, span: int) -> np.ndarray:
        """Smallest hash of the word pairs of the window from each word on."""
        pairs = mix(self.hashes[:-1] * _STEP + self.hashes[1:]) if span > 1 else self.hashes
        width = max(span - 1, 1)
        least, covered = pairs, 1
        while covered < width:
            step = min(covered, width - covered)
            least = np.minimum(least[:-step], least[step:])
            covered += step
        return least

    def slices(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Packed strings from word to word."""
        begin, end = self.starts[first].tolist(), (self.starts[last] + self.sizes[last]).tolist()
        packed = self.packed
        return [packed[a:b] for a, b in zip(begin, end)]


def pieces(text: bytes, span: int) -> Iterator[tuple[bytes, int]]:
    """A text, or a long one in pieces that overlap by a window less one word, with the number of
    its words before each piece."""
    if len(text) <= 2 * PORTION_BYTES:
        yield text, 0
        return
    at, before = 0, 0
    while True:
        stop = at + PORTION_BYTES
        while stop < len(text) and text[stop] not in _SPACES:
            stop += 1
        if stop >= len(text):
            yield text[at:], before
            return
        reach = 4096
        while len(text[stop : stop + reach].split()) <= span and stop + reach < len(text):
            reach *= 2
        after = text[stop : stop + reach].split()[: span - 1]  # cut words are beyond these
        yield b" ".join([text[at:stop], *after]), before
        before += len(text[at:stop].split())
        at = stop

"""Language identification by cross-parsing.

For every language a suffix automaton holds all substrings of a labelled sample. A text is parsed
from left to right into phrases, each the longest match in the sample that starts there; a
character the sample lacks is a phrase of its own. The fewer phrases, the more the text is like
the sample: ``phrases * log2(sample size) / text size`` estimates the bits a character takes, and
the language with the fewest bits wins.

The sample is bounded (``texts`` texts and ``chars`` characters a language), so the automata have a
proven size, are built on the driver and broadcast as one hashed transition table, which grows with
the transitions there are and not with the alphabet. Every letter of the samples is a symbol. Tasks
parse many stretches of ``STRETCH`` characters at once, one character a step, each as if a phrase
began with it. A phrase that goes on beyond its stretch is then followed into the next one, until a
phrase begins where one was taken to begin before: from there on both parses are the same. So texts
of any length are parsed whole, as from left to right.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tallystream.llm.common import fields, portions

STRETCH = 1024
#: Times that all unfinished stretches are followed together.
ROUNDS = 4
#: Characters parsed together by one task.
TOGETHER = 3 << 20
UNKNOWN = "und"
RESULT = fields(("lang_pred", T.StringType()), ("score", T.DoubleType()), ("bits", T.DoubleType()))
#: Symbols: a letter that no sample has, and the gap between words; letters follow.
STRANGE, GAP = 0, 1


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learned from: languages, and of each texts and, in all of them, characters."""

    languages: int = 200
    texts: int = 64
    chars: int = 20_000


def labelled(documents: DataFrame) -> DataFrame:
    """Rows that may be learned from: labelled, with id and text, and not held out."""
    known = [F.col(c).isNotNull() for c in ("doc_id", "lang", "text")]
    return documents.where(~held_out() & known[0] & known[1] & known[2])


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def known_labels(documents: DataFrame, bound: Sample) -> list[str]:
    """The labels of most rows, ties to the smallest; with more than ``bound.languages`` a warning says so."""
    counted = labelled(documents).groupBy("lang").count().orderBy(F.desc("count"), "lang")
    found = [r.lang for r in counted.limit(bound.languages + 1).collect()]
    if len(found) > bound.languages:
        warnings.warn(f"only the {bound.languages} labels of most rows are learned; see Sample.languages", stacklevel=2)
    return found[: bound.languages]


def allotments(sizes: list[int], total: int) -> list[int]:
    """``total`` dealt out so that none gets more than its size and what is left is shared alike."""
    given = [0] * len(sizes)
    waiting = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
    for n, i in enumerate(waiting):
        given[i] = min(sizes[i], total // (len(waiting) - n))
        total -= given[i]
    return given


def sample_texts(documents: DataFrame, bound: Sample) -> dict[str, list[str]]:
    """Stretches of texts per language, the same for every partitioning.

    Of the rows that have a letter, those ``bound.texts`` whose id and text hash lowest are taken;
    equal rows are one text. ``bound.chars`` characters are dealt over them: short texts are taken
    whole, and a longer one gives one stretch that begins where its hash says.
    """
    labels = known_labels(documents, bound)
    if not labels:
        return {}
    rows = (
        labelled(documents)
        .where(F.col("lang").isin(labels) & F.col("text").rlike(r"\p{L}"))
        .select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    )
    # The rank is bounded before the shuffle too, so a label that most rows have stays small.
    lowest = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = (
        rows.select("lang", "h", F.length("text").alias("size"))
        .withColumn("rank", lowest)
        .where(F.col("rank") <= bound.texts)
        .select("lang", "h", "size")
        .distinct()
        .collect()
    )
    by_label: dict[str, list] = {}
    for r in sorted(chosen, key=lambda r: (r.lang, r.h)):
        by_label.setdefault(r.lang, []).append(r)
    if missing := sorted(set(labels) - set(by_label)):
        warnings.warn(f"no letter in the texts of {missing}; these labels are not learned", stacklevel=2)
    plan = [
        (r.lang, r.h, r.h % (r.size - given + 1) + 1, given)
        for some in by_label.values()
        for r, given in zip(some, allotments([r.size for r in some], bound.chars))
    ]
    if not plan:
        return {}
    # At most languages * texts rows.
    planned = documents.sparkSession.createDataFrame(plan, "lang string, h long, start int, taken int")
    stretch = F.col("text").substr(F.col("start"), F.col("taken"))
    taken = rows.join(F.broadcast(planned), ["lang", "h"]).select("lang", "h", stretch.alias("text")).distinct().collect()
    found: dict[str, list[str]] = {}
    for r in sorted(taken, key=lambda r: (r.lang, r.h, r.text)):
        found.setdefault(r.lang, []).append(r.text)
    return found


class Alphabet:
    """Symbols of characters: a letter of the samples its own, other letters one, all else a gap."""

    def __init__(self, letters: list[str]):
        self.letters = letters
        points = np.full(0x110000, GAP, np.int32)
        alphabetic = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        points[alphabetic] = STRANGE
        for n, letter in enumerate(letters):
            points[ord(letter)] = n + 2
        self._points = points

    @property
    def size(self) -> int:
        return len(self.letters) + 2

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a lower-cased text, runs of gaps as one and none at the ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        found = self._points[points]
        gap = found == GAP
        keep = ~gap
        keep[1:] |= gap[1:] & ~gap[:-1]
        found = found[keep]
        if len(found) and found[0] == GAP:
            found = found[1:]
        if len(found) and found[-1] == GAP:
            found = found[:-1]
        return found


def suffix_automaton(symbols: list[int | None]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; no substring goes across a None."""
    edges: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        if symbol is None:
            last = 0
            continue
        if symbol in edges[last]:  # after a break the state may be there already
            to = edges[last][symbol]
            if length[to] == length[last] + 1:
                last = to
                continue
            copy = len(edges)
            edges.append(dict(edges[to]))
            link.append(link[to])
            length.append(length[last] + 1)
            link[to] = copy
            p = last
            while p >= 0 and edges[p].get(symbol) == to:
                edges[p][symbol] = copy
                p = link[p]
            last = copy
            continue
        new = len(edges)
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and symbol not in edges[p]:
            edges[p][symbol] = new
            p = link[p]
        if p >= 0:
            to = edges[p][symbol]
            if length[to] == length[p] + 1:
                link[new] = to
            else:
                copy = len(edges)
                edges.append(dict(edges[to]))
                link.append(link[to])
                length.append(length[p] + 1)
                link[to] = link[new] = copy
                while p >= 0 and edges[p].get(symbol) == to:
                    edges[p][symbol] = copy
                    p = link[p]
        last = new
    return edges


_MIX = np.uint64(0x9E3779B97F4A7C15)


class Transitions:
    """Where a state and a symbol lead, by open addressing; half of the slots stay free."""

    def __init__(self, width: int, states: np.ndarray, symbols: np.ndarray, to: np.ndarray):
        self.width = width
        wanted = states * np.int64(width) + symbols
        size = 2 * len(wanted) + 1
        self.keys = np.full(size, -1, np.int64)
        self.to = np.zeros(size, np.int32)
        at = self._slots(wanted)
        while len(wanted):
            free = self.keys[at] < 0
            self.keys[at[free]] = wanted[free]
            placed = self.keys[at] == wanted
            self.to[at[placed]] = to[placed]
            wanted, to, at = wanted[~placed], to[~placed], self._next(at[~placed])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * _MIX >> np.uint64(32)
        return (mixed * np.uint64(len(self.keys)) >> np.uint64(32)).view(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        at = at + 1
        at[at == len(self.keys)] = 0
        return at

    def follow(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next states; 0 where there is none."""
        wanted = (states * np.int64(self.width) + symbols).ravel()
        at = self._slots(wanted)
        there = self.keys.take(at)
        same = there == wanted
        out = self.to.take(at) * same
        left = np.flatnonzero(~same & (there >= 0))
        wanted, at = wanted[left], at[left]
        while len(left):
            at = self._next(at)
            there = self.keys.take(at)
            same = there == wanted
            out[left[same]] = self.to[at[same]]
            more = ~same & (there >= 0)
            left, wanted, at = left[more], wanted[more], at[more]
        return out.reshape(states.shape)

    def follow_one(self, state: int, symbol: int) -> int:
        """``follow`` of one state."""
        wanted, size = state * self.width + symbol, len(self.keys)
        at = ((wanted * int(_MIX) & 0xFFFFFFFFFFFFFFFF) >> 32) * size >> 32
        while (there := self.keys.item(at)) != wanted:
            if there < 0:
                return 0
            at = at + 1 if at + 1 < size else 0
        return self.to.item(at)


@dataclass(frozen=True)
class Model:
    """Languages, letters, and the transitions of all automata.

    State 0 has no transitions, so that a parse there begins a phrase. ``first`` has, per language,
    where a phrase's first symbol leads.
    """

    languages: list[str]
    letters: list[str]
    table: Transitions
    first: np.ndarray
    bits: np.ndarray


def learn(texts: dict[str, list[str]]) -> Model:
    lowered = {lang: [t.lower() for t in some] for lang, some in texts.items()}
    letters = sorted({c for some in lowered.values() for text in some for c in set(text) if c.isalpha()})
    alphabet = Alphabet(letters)
    languages, rows, first, bits, empty = [], 1, [], [], []
    states, labels, targets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for lang in sorted(lowered):
        symbols: list[int | None] = []
        for text in lowered[lang]:
            symbols += [*alphabet.symbols(text).tolist(), None]
        if all(s is None or s == GAP for s in symbols):
            empty.append(lang)
            continue
        edges = suffix_automaton(symbols)
        count = sum(map(len, edges))
        states.append(rows + np.repeat(np.arange(len(edges)), np.fromiter(map(len, edges), np.int64, len(edges))))
        labels.append(np.fromiter((s for out in edges for s in out), np.int64, count))
        targets.append(rows + np.fromiter((to for out in edges for to in out.values()), np.int32, count))
        begin = np.zeros(alphabet.size, np.int32)
        begin[list(edges[0])] = [rows + to for to in edges[0].values()]
        languages.append(lang)
        first.append(begin)
        bits.append(math.log2(max(2, len(symbols))))
        rows += len(edges)
    if empty:
        warnings.warn(f"no letter in the samples of {empty}; these labels are not learned", stacklevel=2)
    width = alphabet.size
    return Model(
        languages,
        letters,
        Transitions(width, *map(np.concatenate, (states, labels, targets))),
        np.array(first, np.int32).reshape(len(languages), width),
        np.array(bits),
    )


class Parser:
    def __init__(self, model: Model):
        self.model = model
        self.alphabet = Alphabet(model.letters)
        # A byte is held for each character and language.
        self.together = max(STRETCH, TOGETHER * 8 // max(8, len(model.languages)))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of every text (symbols) under every language."""
        model, kinds = self.model, len(self.model.languages)
        totals = np.zeros((len(texts), kinds), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum() or not kinds:
            return totals
        joined = np.concatenate(texts).astype(np.int32)
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = begins[owner] + number * STRETCH
        size = np.minimum(STRETCH, sizes[owner] - number * STRETCH)
        order = np.argsort(-size, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        follower = np.full(len(order), -1, np.int64)
        goes_on = np.flatnonzero(owner[1:] == owner[:-1])
        follower[place[goes_on]] = place[goes_on + 1]
        owner, start, size = owner[order], start[order], size[order]
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # stretches longer than the step
        count = np.zeros((kinds, len(owner)), np.int64)
        state = np.zeros((kinds, len(owner)), np.int32)
        begun = []  # by step, where phrases begin; only a stretch that follows another needs it
        for step in range(int(size[0])):
            n = int(active[step])
            symbol = joined[start[:n] + step]
            to = model.table.follow(state[:, :n], symbol)
            ended = to == 0
            count[:, :n] += ended
            state[:, :n] = np.where(ended, model.first[:, symbol], to)
            if len(goes_on):
                begun.append(ended)
        if len(goes_on):
            count += self._beyond(joined, start, size, follower, state, begun)
        for kind in range(kinds):
            totals[:, kind] = np.bincount(owner, count[kind], len(texts)).astype(np.int64)
        return totals

    def _beyond(self, joined, start, size, follower, state, begun) -> np.ndarray:
        """By how much the phrases of a stretch are more, given where the one before it ends.

        A stretch whose end changes sends its follower through again; since the first of each
        text is right from the start, so are one more of each after every round. Where parses don't
        come together for long, as in a text that repeats a few characters, what is left after
        ``ROUNDS`` is walked through in order.
        """
        model = self.model
        more = np.zeros(state.shape, np.int64)
        ends = state.copy()
        kind, before = (a.ravel() for a in np.indices(state.shape))
        for _ in range(ROUNDS):
            goes_on = follower[before] >= 0
            kind, before = kind[goes_on], before[goes_on]
            if not len(kind):
                return more
            lane = follower[before]
            held, gained = ends[kind, before], np.zeros(len(kind), np.int64)
            live, apart = np.arange(len(kind)), np.zeros(len(kind), bool)
            for step in range(int(size[lane].max())):
                over = size[lane[live]] <= step
                apart[live[over]] = True
                live = live[~over]
                if not len(live):
                    break
                k, at = kind[live], lane[live]
                symbol = joined[start[at] + step]
                to = model.table.follow(held[live], symbol)
                ended, there = to == 0, begun[step][k, at]
                held[live] = np.where(ended, model.first[k, symbol], to)
                gained[live] += ended.astype(np.int64) - there
                live = live[~(ended & there)]
            apart[live] = True
            more[kind, lane] = gained
            new = np.where(apart, held, state[kind, lane])
            changed = new != ends[kind, lane]
            ends[kind, lane] = new
            kind, before = kind[changed], lane[changed]
        walked = set()
        for k, at in sorted(zip(kind.tolist(), before.tolist()), key=lambda edge: (edge[0], start[edge[1]])):
            first = model.first[k]
            while (k, at) not in walked and follower[at] >= 0:
                walked.add((k, at))
                lane, held, gained, apart = int(follower[at]), int(ends[k, at]), 0, True
                for step, symbol in enumerate(joined[start[lane] : start[lane] + size[lane]].tolist()):
                    to = model.table.follow_one(held, symbol)
                    there = bool(begun[step][k, lane])
                    if to == 0 and there:
                        apart = False
                        break
                    gained += (to == 0) - there
                    held = to or int(first[symbol])
                more[k, lane] = gained
                new = held if apart else int(state[k, lane])
                if new == ends[k, lane]:
                    break
                ends[k, lane] = new
                at = lane
        return more

    def identify(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        """Language, score and bits per symbol of each text."""
        symbols = [self.alphabet.symbols(t or "") for t in texts]
        phrases = self.phrases(symbols)
        out: list[tuple[str, float, float | None]] = []
        for own, counted in zip(symbols, phrases):
            if not len(own) or not self.model.languages:
                out.append((UNKNOWN, 0.0, None))
                continue
            bits = counted * self.model.bits / len(own)
            best = int(np.argmin(bits))
            rest = np.delete(bits, best)
            score = 1.0 if not len(rest) else 1.0 - float(bits[best] / rest.min())
            out.append((self.model.languages[best], score, float(bits[best])))
        return out


_PARSERS: dict[str, Parser] = {}


def identify_language(text, model_of, key: str):
    """Struct column lang_pred, score, bits of a text column under a broadcast model."""

    @F.pandas_udf(RESULT)
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = Parser(model_of.value)
        parser = _PARSERS[key]
        for batch in batches:
            rows = [r for some in portions(batch.tolist(), parser.together) for r in parser.identify(some)]
            yield pd.DataFrame(rows, columns=RESULT.names)

    # Else a filter on the result would make the optimizer run it once more.
    return identify.asNondeterministic()(F.coalesce(text, F.lit("")))


@F.pandas_udf(T.BooleanType())
def has_letter(texts: pd.Series) -> pd.Series:
    """Whether language identification sees a letter; false for null."""
    return texts.map(lambda t: t is not None and any(map(str.isalpha, t.lower()))).astype(bool)


def learned(documents: DataFrame, bound: Sample = Sample()):
    """Broadcast model of a table's labelled rows, and its name in the workers."""
    model = learn(sample_texts(documents, bound))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return shared, f"{documents.sparkSession.sparkContext.applicationId}-{id(shared)}"


def predict_languages(documents: DataFrame, bound: Sample = Sample()) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, bits.

    ``lang_pred`` is a learned label, or ``und`` where the text is null or has no letter or
    nothing could be learned; ``score`` is the share of bits saved against the second language, 0
    for a tie (the first label in order wins it) and 1 where only one label is known. A null
    doc_id is not held out and never learned from. Other columns are not read.
    """
    model, key = learned(documents, bound)
    found = documents.select("doc_id", held_out().alias("held_out"), identify_language(F.col("text"), model, key).alias("r"))
    return found.select("doc_id", "held_out", "r.*")


def keep_identified(documents: DataFrame, bound: Sample = Sample(), most_bits: float | None = None) -> DataFrame:
    """Rows whose language is found, with all their columns; ``und`` goes, and with ``most_bits``
    also what is that unlike every learned language. A null ``lang`` becomes the predicted label;
    given ones stay. Repeated rows and ties are judged row by row.

    Where nothing could be learned, no language can be told from another: all rows whose text has a
    letter stay, whatever ``most_bits``, and a warning says so.
    """
    model, key = learned(documents, bound)
    if not model.value.languages:
        warnings.warn("no label could be learned; all documents with a letter are kept", stacklevel=2)
        return documents.where(has_letter(F.col("text")))
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"),
        identify_language(F.col("text"), model, key).alias("r"),
    )
    rows = rows.where(F.col("r.lang_pred") != UNKNOWN)
    if most_bits is not None:
        rows = rows.where(F.col("r.bits") <= most_bits)
    whole = {c: F.col(f"whole.`{c}`") for c in documents.columns}
    return rows.select(*[(F.coalesce(v, F.col("r.lang_pred")) if c == "lang" else v).alias(c) for c, v in whole.items()])

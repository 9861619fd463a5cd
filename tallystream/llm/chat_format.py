"""Chat formatting with compiled templates.

A template is text with ``{{ expression }}``, ``{% for x in messages %}``, ``{% if %}`` /
``{% elif %}`` / ``{% else %}`` / ``{% endif %}`` and ``{% generation %}`` ... ``{% endgeneration %}``,
which marks what a model is to learn. Expressions are names, fields (``m.text``), strings,
numbers, ``+``, ``==``, ``!=``, ``and``, ``or``, ``not`` and listed filters (``| escape``); nothing
else can be reached. It is parsed into a syntax tree, constant parts are folded, and the tree
becomes Python closures. These are generators of pieces that take messages from an iterator, so a
conversation of any length is rendered piece by piece.

Rows of a conversation meet in one task, in order, but are never held together: output longer
than ``PART_CHARS`` goes on in the next part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Code points after which a formatted conversation goes on in another row.
PART_CHARS = 1 << 20
ROWS_TOGETHER = 256

TURN_TEMPLATE = (
    "{% for m in messages %}<turn>{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
# A backslash before a character takes its meaning away; it is put before backslashes and the
# first character of a control string, in roles also before line ends.
_CONTROL, _CONTROL_LINE = re.compile(r"\\|<(?=/?turn>)"), re.compile(r"[\\\n]|<(?=/?turn>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<turn>((?:[^\\\n]++|\\.)*+)\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def escape_line(text: str) -> str:
    return _CONTROL_LINE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


class TemplateError(ValueError):
    pass


# Syntax tree: ("text", s) ("show", expr) ("for", name, body) ("if", [(expr, body)], otherwise)
# ("mark", body); expressions ("const", v) ("name", n) ("field", expr, n) ("filter", expr, n)
# ("not", expr) ("and" | "or" | "==" | "!=" | "+", a, b).

_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.DOTALL)
_LEXEME = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|+.()\[\]]))")
_STRING_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the words of one expression."""

    def __init__(self, source: str):
        self.words: list[tuple[str, object]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = _LEXEME.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            string, number, name, sign = m.groups()
            if string is not None:
                value = re.sub(r"\\(.)", lambda e: _STRING_ESCAPES.get(e[1], e[1]), string[1:-1], flags=re.DOTALL)
                self.words.append(("const", value))
            elif number is not None:
                self.words.append(("const", int(number)))
            else:
                self.words.append(("word" if name else "sign", name or sign))
            at = m.end()
        self.at = 0

    def next_is(self, *wanted: str) -> str | None:
        if self.at < len(self.words):
            kind, value = self.words[self.at]
            if kind != "const" and value in wanted:
                self.at += 1
                return str(value)
        return None

    def whole(self):
        found = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")
        return found

    def either(self):
        left = self.both()
        while self.next_is("or"):
            left = ("or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.next_is("and"):
            left = ("and", left, self.negated())
        return left

    def negated(self):
        return ("not", self.negated()) if self.next_is("not") else self.compared()

    def compared(self):
        left = self.joined()
        sign = self.next_is("==", "!=")
        return (sign, left, self.joined()) if sign else left

    def joined(self):
        left = self.filtered()
        while self.next_is("+"):
            left = ("+", left, self.filtered())
        return left

    def filtered(self):
        found = self.value()
        while self.next_is("|"):
            name = self.word()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            found = ("filter", found, name)
        return found

    def word(self) -> str:
        if self.at < len(self.words) and self.words[self.at][0] == "word":
            self.at += 1
            return str(self.words[self.at - 1][1])
        raise TemplateError("a name is missing")

    def value(self):
        if self.next_is("("):
            found = self.either()
            if not self.next_is(")"):
                raise TemplateError("a bracket is open")
        elif self.at < len(self.words) and self.words[self.at][0] == "const":
            found = self.words[self.at]
            self.at += 1
        else:
            found = ("name", self.word())
        while True:
            if self.next_is("."):
                found = ("field", found, self.word())
            elif self.next_is("["):
                key = self.either()
                if key[0] != "const" or not self.next_is("]"):
                    raise TemplateError("a constant key and ] are needed")
                found = ("field", found, key[1])
            else:
                return found


def parse(template: str) -> list:
    """Syntax tree of a template."""
    tokens: list[tuple[str, str]] = []
    at = 0
    for m in _PIECE.finditer(template):
        if m.start() > at:
            tokens.append(("text", template[at : m.start()]))
        if m.group(1) is not None:
            tokens.append(("show", m.group(1)))
        elif m.group(2) is not None:
            tokens.append(("tag", m.group(2).strip()))
        at = m.end()
    if at < len(template):
        tokens.append(("text", template[at:]))
    place = 0

    def body(*ends: str) -> tuple[list, str]:
        nonlocal place
        found: list = []
        while place < len(tokens):
            kind, source = tokens[place]
            place += 1
            if kind == "text":
                found.append(("text", source))
            elif kind == "show":
                found.append(("show", _Expression(source).whole()))
            else:
                word = source.split(None, 1)[0] if source else ""
                if word in ends:
                    return found, source
                found.append(tag(word, source))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return found, ""

    def tag(word: str, source: str):
        if word == "for":
            m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", source)
            if not m:
                raise TemplateError("only messages can be gone through")
            return ("for", m[1], body("endfor")[0])
        if word == "generation":
            return ("mark", body("endgeneration")[0])
        if word == "if":
            cases, otherwise, end = [], [], source
            while end.split(None, 1)[0] in ("if", "elif"):
                condition = _Expression(end.split(None, 1)[1] if " " in end else "").whole()
                inside, end = body("elif", "else", "endif")
                cases.append((condition, inside))
            if end == "else":
                otherwise, end = body("endif")
            return ("if", cases, otherwise)
        raise TemplateError(f"no tag {word!r}")

    return body()[0]


def _fold_value(node):
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind in ("field", "filter"):
        inner = _fold_value(node[1])
        if kind == "filter" and inner[0] == "const":
            return ("const", FILTERS[node[2]](str(inner[1])))
        return (kind, inner, node[2])
    parts = [_fold_value(n) for n in node[1:]]
    if all(p[0] == "const" for p in parts):
        return ("const", _value((kind, *parts), set())({}))
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    return (kind, *parts)


def fold(body: list) -> list:
    """The tree with constant expressions worked out, dead branches gone and texts joined."""
    out: list = []
    for node in body:
        kind = node[0]
        if kind == "show":
            value = _fold_value(node[1])
            new = [("text", str(value[1]))] if value[0] == "const" else [("show", value)]
        elif kind == "for":
            new = [("for", node[1], fold(node[2]))]
        elif kind == "mark":
            new = [("mark", fold(node[1]))]
        elif kind == "if":
            cases, otherwise = [], fold(node[2])
            for condition, inside in node[1]:
                condition = _fold_value(condition)
                if condition[0] != "const":
                    cases.append((condition, fold(inside)))
                elif condition[1]:
                    otherwise = fold(inside)
                    break
            new = [("if", cases, otherwise)] if cases else otherwise
        else:
            new = [node]
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


def _value(node, names: set[str]) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda scope, v=node[1]: v
    if kind == "name":
        if node[1] not in names:
            raise TemplateError(f"no name {node[1]!r}")
        return lambda scope, n=node[1]: scope[n]
    if kind == "field":
        inner, name = _value(node[1], names), node[2]

        def field(scope):
            holder = inner(scope)
            if not isinstance(holder, dict):
                raise TemplateError(f"no field {name!r}")
            return holder.get(name, "")

        return field
    if kind == "filter":
        inner, apply = _value(node[1], names), FILTERS[node[2]]
        return lambda scope: apply(str(inner(scope)))
    if kind == "not":
        inner = _value(node[1], names)
        return lambda scope: not inner(scope)
    a, b = _value(node[1], names), _value(node[2], names)
    return {
        "and": lambda scope: a(scope) and b(scope),
        "or": lambda scope: a(scope) or b(scope),
        "==": lambda scope: a(scope) == b(scope),
        "!=": lambda scope: a(scope) != b(scope),
        "+": lambda scope: str(a(scope)) + str(b(scope)),
    }[kind]


BEGIN, END = object(), object()
Render = Callable[[dict], Iterator[object]]


def _node(node, names: set[str]) -> Render:
    kind = node[0]
    if kind == "text":
        return lambda scope, t=node[1]: iter((t,))
    if kind == "show":
        value = _value(node[1], names)
        return lambda scope: iter((str(value(scope)),))
    if kind == "mark":
        inside = _body(node[1], names)

        def mark(scope):
            yield BEGIN
            yield from inside(scope)
            yield END

        return mark
    if kind == "if":
        cases = [(_value(c, names), _body(b, names)) for c, b in node[1]]
        otherwise = _body(node[2], names)

        def choose(scope):
            for condition, inside in cases:
                if condition(scope):
                    return inside(scope)
            return otherwise(scope)

        return choose
    name, inside = node[1], _body(node[2], names | {node[1], "loop"})

    def each(scope):
        waiting = iter(scope["messages"])
        message, index = next(waiting, None), 1
        while message is not None:
            after = next(waiting, None)
            loop = {"index": index, "first": index == 1, "last": after is None}
            yield from inside({**scope, name: message, "loop": loop})
            message, index = after, index + 1

    return each


def _body(body: list, names: set[str]) -> Render:
    nodes = [_node(n, names) for n in body]

    def run(scope):
        for node in nodes:
            yield from node(scope)

    return run


def _loops(body: list) -> int:
    """Loops over the messages that one rendering can come to; messages are streamed, once."""
    most = 0
    for node in body:
        if node[0] == "for":
            if _loops(node[2]):
                raise TemplateError("a loop over messages stands within another")
            most += 1
        elif node[0] == "mark":
            most += _loops(node[1])
        elif node[0] == "if":
            most += max(_loops(inside) for inside in (*(b for _, b in node[1]), node[2]))
    return most


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[object]]:
    """A function from messages (role and text) to pieces: strings, and BEGIN and END of learned text.

    A template that would go through the messages twice is refused.
    """
    tree = fold(parse(template))
    if _loops(tree) > 1:
        raise TemplateError("messages can be gone through once")
    run = _body(tree, {"messages"})
    return lambda messages: run({"messages": messages})


FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("loss_starts", T.ArrayType(T.LongType())),
        T.StructField("loss_ends", T.ArrayType(T.LongType())),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)
_FORMATTED_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("formatted", pa.string()),
        ("loss_starts", pa.list_(pa.int64())),
        ("loss_ends", pa.list_(pa.int64())),
    ]
)
_DIGESTS_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterable[tuple], schema: pa.Schema, chars: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    held = 0
    for row in rows:
        some.append(row)
        held += chars(row)
        if len(some) >= ROWS_TOGETHER or held >= PART_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some, held = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _parts(conv_id, pieces: Iterator[object], part_chars: int) -> Iterator[tuple]:
    """Rows of one conversation; a learned stretch that goes on in the next part has a span in each."""
    part, size, text, starts, ends, learning = 0, 0, [], [], [], False
    for piece in pieces:
        if piece is BEGIN:
            learning = True
            starts.append(size)
        elif piece is END:
            learning = False
            ends.append(size)
        else:
            text.append(piece)
            size += len(piece)
            if size >= part_chars:
                yield conv_id, part, "".join(text), starts, [*ends, size] if learning else ends
                part, size, text, starts, ends = part + 1, 0, [], [0] if learning else [], []
    if text or starts or not part:
        yield conv_id, part, "".join(text), starts, ends


def format_conversations(conversations: DataFrame, template: str = TURN_TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted conversations: conv_id, part, formatted, loss_starts, loss_ends (code points).

    Turns go by ``turn``, turns of equal number by role and text, null numbers first. Null roles
    and texts are empty. Rows without conv_id are one conversation. Repeated rows are turns of
    their own. Only conv_id, turn, role and text are read. Parts of a conversation stand in order
    in one partition.
    """
    compile_template(template)  # faults show on the driver

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template)

        def rows():
            for conv_id, turns in groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"role": role, "text": text} for _, _, role, text in turns)
                yield from _parts(conv_id, run(messages), part_chars)

        return _batches(rows(), _FORMATTED_ARROW, lambda r: len(r[2]))

    empty = F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(work, FORMATTED)


def read_turns(formatted: str) -> Iterator[tuple[str, str, int]]:
    """Role, text and end of every whole turn in output of the turn template."""
    at = 0
    while m := _TURN.match(formatted, at):
        at = m.end()
        yield unescape(m[1]), unescape(m[2]), at


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from output of the turn template, one row per conversation."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv_id, parts in groupby(_rows(batches), key=lambda r: r[0]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
                rest = ""
                for _, _, text, starts, ends in parts:
                    chars += len(text)
                    for start, end in zip(starts, ends):
                        learned = unescape(text[start:end])
                        loss.update(learned.encode("utf-8", "surrogatepass"))
                        loss_chars += len(learned)
                    rest, done = rest + text, 0
                    for role, said, done in read_turns(rest):
                        turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                        n_turns += 1
                    rest = rest[done:]
                if rest:
                    raise ValueError("output that is no turn")
                yield conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        return _batches(rows(), _DIGESTS_ARROW, lambda r: 0)

    return formatted.mapInArrow(work, DIGESTS)

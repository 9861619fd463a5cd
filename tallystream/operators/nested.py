"""Tables that hold tables, read by the depth of their tags.

Every tag of a table, row or cell has the number of tables that are open around it, and an element
reaches from its opening tag to the next tag that ends it: its own end tag, the next cell or row of the same table, or the end of
that table. What lies deeper belongs to it whole. So the cells of a row are all cells within, those
of inner tables included and in document order; the rows of a table are all rows within; and a cell's
text is all text within.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F

_TABLE_TAG = r"(?i)(?=</?table\b)"
_TAG_NAME = r"(?i)<(/?(?:table|tr|td|th))\b"
_NAME = r"(?i)\A<(/?table)\b"

_OPEN, _CLOSE = "table", "/table"
_ROW = ("tr",)
_ENDS_ROW = ("tr", "/tr")
_ENDS_CELL = (*_ENDS_ROW, "td", "th", "/td", "/th")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _names(pieces: Column) -> Column:
    return F.transform(pieces, lambda p: F.lower(F.regexp_extract(p, _NAME, 1)))


def _depths(names: Column) -> Column:
    """Tables open at each piece; an opening tag is within its table, an end tag outside."""

    def step(so_far: Column, name: Column) -> Column:
        depth = so_far["depth"] + F.when(name == _OPEN, 1).when(name == _CLOSE, -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.array_append(so_far["all"], depth).alias("all"))

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(names, start, step, lambda done: done["all"])


def balanced_table(markup: Column) -> Column:
    """Text that begins with a table's opening tag, up to the end tag of that table.

    A table that is never closed reaches to the last end tag of a table within; without any it is empty.
    """

    def cut(pieces: Column, names: Column, depths: Column) -> Column:
        closing = F.transform(F.arrays_zip(names.alias("n"), depths.alias("d")), lambda x: (x["n"] == _CLOSE) & (x["d"] <= 0))
        last = F.size(names) - F.array_position(F.reverse(names), _CLOSE) + 1
        reach = F.when(F.array_contains(closing, True), F.array_position(closing, True))
        reach = reach.when(F.array_contains(names, _CLOSE), last).otherwise(0).cast("int")
        return _let(
            reach,
            lambda n: F.when(n > 0, F.concat(F.array_join(F.slice(pieces, F.lit(1), n - 1), ""), F.lit("</table>"))).otherwise(""),
        )

    return _let(F.split(markup, _TABLE_TAG), lambda p: _let(_names(p), lambda n: _let(_depths(n), lambda d: cut(p, n, d))))


def _marked_up(cells: tuple[str, ...], head: tuple[str, ...], plain: Callable[[str], str]):
    """Markup of the cells of ``nested_rows``; defined here so that workers need not import this package."""
    tag = re.compile(_TAG_NAME)
    opens, closes, row, ends_row, ends_cell = _OPEN, _CLOSE, _ROW, _ENDS_ROW, _ENDS_CELL

    def read_one(markup: str) -> tuple[list, list]:
        # At most one cell and one row is open per depth, so one pass over the tags is enough.
        depth, open_cells, open_rows = 0, {}, {}
        kinds, spans, rows = [], [], []
        for found in tag.finditer(markup):
            name, at = found.group(1).lower(), found.start()
            over = depth  # what this tag ends lies this deep
            if name == opens:
                depth += 1
            elif name == closes:
                depth -= 1
            if name == closes or name in ends_cell:
                if over in open_cells:
                    spans[open_cells.pop(over)][1] = at
                if over in open_rows and (name == closes or name in ends_row):
                    rows[open_rows.pop(over)][1] = len(spans)
            if name in row:
                open_rows[depth] = len(rows)
                rows.append([len(spans), None])
            elif name in ("td", "th"):
                open_cells[depth] = len(spans)
                kinds.append(name)
                spans.append([at, len(markup)])
        texts = [markup[a:b] for a, b in spans]
        inside = [[texts[i] for i in range(a, len(texts) if b is None else b) if kinds[i] in cells] for a, b in rows]
        return [t for t, k in zip(texts, kinds) if k in head], inside

    def read(markup: pd.Series) -> pd.DataFrame:
        found = [(None, None) if m is None else read_one(plain(m)) for m in markup]
        return pd.DataFrame({"head": [h for h, _ in found], "rows": [r for _, r in found]})

    return F.pandas_udf(read, "head array<string>, rows array<array<string>>")


def nested_rows(table: Column, cells: tuple[str, ...], head: tuple[str, ...], plain: Callable[[str], str]) -> Column:
    """Struct of a table's markup: ``head``, all cells of some kinds in document order, and ``rows``, per row
    all cells of some kinds within it. ``plain`` is done to the table first.

    A fold per cell over all tags took time with the square of a table's tags, so its tags are gone
    through once, in Python; only tables that hold tables should come here.
    """
    return _marked_up(cells, head, plain)(table)

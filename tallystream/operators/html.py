"""Statement tables out of stored web pages.

A page is one row and stays one row until its table is unfolded, so extraction, transposition
and cleaning need no shuffle at all.

Unfolding uses the outer generators and drops the null row afterwards. A plain generator, or a
filter below it, would make the optimizer push a size test through the projections and run the
page-wide patterns a second time.
"""

from __future__ import annotations

import html as _html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallystream.functions.clean import (
    clean_number,
    normalize_header,
    number_text,
    number_value,
    strip_text,
)
from tallystream.operators.nested import balanced_table, nested_rows
from tallystream.schemas import LABEL_MARK, METRICS, SCRAPED, SCRAPED_TO_METRIC, TRAILING_PERIOD, YEAR

SECTION_ID = "profit-loss"
COMPANY_URL = r"/company/(.+?)/"

# Entities decoded in the JVM; the ampersand comes last, so nothing is decoded twice.
_ENTITIES = [
    ("&nbsp;", "\u00a0"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&amp;", "&"),
]
_RARE_ENTITY = r"&(?!(?:nbsp|lt|gt|quot|apos|#39|amp);)(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"
_INVISIBLE = r"(?is)<(?:!--.*?-->|(script|style)\b[^>]*>.*?</\1\s*>)"


def _rare_decoder():
    """Text to text; defined here so that workers need not import this package."""
    rare = re.compile(_RARE_ENTITY)

    def plain(match):
        # Characters that could read as markup stay escaped.
        return _html.escape(_html.unescape(match.group(0)), quote=False)

    return lambda markup: rare.sub(plain, markup)


def decode_rare_entities(markup: Column) -> Column:
    """All entities but the common ones; only markup that holds some goes through Python."""
    plain = _rare_decoder()

    def decode(markup: pd.Series) -> pd.Series:
        return markup.map(lambda m: None if m is None else plain(m))

    needs = markup.rlike(_RARE_ENTITY)
    return F.coalesce(F.pandas_udf(decode, T.StringType())(F.when(needs, markup)), markup)


# Visible ASCII, with spaces between, that has neither tags nor entities: nothing to do.
_PLAIN_CELL = r"\A(?:[!-%'-;=-~](?:[ -%'-;=-~]*[!-%'-;=-~])?)?\z"


def cell_text(markup: Column) -> Column:
    """Text of a cell: no tags, entities decoded, stripped."""
    bare = F.when(markup.contains("<"), F.regexp_replace(markup, "<[^>]*>", "")).otherwise(markup)
    text = bare
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    read = strip_text(F.when(bare.contains("&"), text).otherwise(bare))
    return F.when(markup.rlike(_PLAIN_CELL), markup).otherwise(read)


def _elements(markup: Column, tag: str) -> Column:
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"
    return F.regexp_extract_all(markup, F.lit(pattern), 1)


def _open_elements(markup: Column, tag: str, ends: str) -> Column:
    """Elements that may lack their end tags: each goes to its end tag, or to what ends it as well.

    ``ends`` follows a ``<``. Only there an element may end, so what lies between is passed over whole.
    """
    pattern = rf"(?is)<{tag}\b[^>]*>([^<]*+(?:<(?!/{tag}\s*>|{ends})[^<]*+)*+)"
    return F.regexp_extract_all(markup, F.lit(pattern), 1)


_NEXT_CELL, _NEXT_ROW = r"t[hdr]\b|/t(?:r|able|head|body|foot)\b", r"tr\b|/table\b"


def _with_table(pages: DataFrame, section_id: str) -> DataFrame:
    """Pages with ``_section``, what stands from the first such section on, and ``_table``, its
    first table; both empty where there is none.

    One column after the other, so that each page-wide pattern runs once.
    """
    opening = rf"(?is)<section[^>]*\sid\s*=\s*([\"']?){re.escape(section_id)}\1(?=[\s>])[^>]*>.*"
    # Inner sections may open and close before the table; once the depth is 0 the section is over.
    steps = F.transform(
        F.regexp_extract_all("_before", F.lit(r"(?i)(</?)section\b"), 1), lambda t: F.when(t == "<", 1).otherwise(-1)
    )
    depth = F.aggregate(steps, F.lit(1), lambda d, t: F.when(d == 0, 0).otherwise(d + t))
    inside = ~F.contains("_before", F.lit("</")) | (depth > 0)
    after = F.substr("_inner", F.length("_before") + 1, F.length("_inner"))
    return (
        pages.withColumn("_section", F.regexp_extract(F.regexp_replace("html", _INVISIBLE, ""), opening, 0))
        .withColumn("_inner", F.substr("_section", F.instr("_section", ">") + 1, F.length("_section")))
        .withColumn("_before", F.regexp_extract("_inner", r"(?is)\A.*?(?=<table\b|\z)", 0))
        .withColumn("_after", F.when(inside, after).otherwise(""))
        .withColumn("_table", F.regexp_extract("_after", r"(?is)\A<table\b.*?</table\s*>", 0))
        .withColumn("_nested", F.regexp_count("_table", F.lit(r"(?i)<table\b")) > 1)
        .withColumn("_table", F.when(F.col("_nested"), balanced_table(F.col("_after"))).otherwise(F.col("_table")))
    )


def _first_element(markup: Column, tag: str, element_id: str | None = None) -> Column:
    """Whole first element, or empty text where there is none."""
    wanted = rf"[^>]*\sid\s*=\s*([\"']?){re.escape(element_id)}\1(?=[\s>])" if element_id else r"\b"
    return F.regexp_extract(markup, rf"(?is)<{tag}{wanted}[^>]*>.*?</{tag}\s*>", 0)


def list_items(pages: DataFrame, container: str = "nav", item: str = "li") -> DataFrame:
    """Items of the first container of each page, in document order."""
    visible = F.regexp_replace("html", _INVISIBLE, "")
    box = pages.select("page_id", _first_element(visible, container).alias("box"))
    decoded = box.select("page_id", decode_rare_entities(F.col("box")).alias("box"))
    items = decoded.select(
        "page_id", F.posexplode_outer(_elements(F.col("box"), item)).alias("item_idx", "markup")
    )
    return items.where(F.col("item_idx").isNotNull()).select(
        "page_id", "item_idx", cell_text(F.col("markup")).alias("text")
    )


def page_key(url: Column, pattern: str = COMPANY_URL) -> Column:
    """Key in a page's address, or null."""
    key = F.regexp_extract(url, pattern, 1)
    return F.when(key != "", key)


def statement_tables(
    pages: DataFrame, section_id: str = SECTION_ID, header_cells_anywhere: bool = True
) -> DataFrame:
    """One row per page: header texts, body rows ``array<struct<row_idx, cells>>`` and ``reason``.

    Inner sections before the table, and cells and rows without end tags, are read. Where a table holds
    another, the inner one's rows are rows of the outer as well, and its cells cells of the row that
    holds it (see ``operators.nested``). ``header_cells_anywhere``: the header is every ``th`` of the table and body cells are ``td``
    only; otherwise the first row is the header and both kinds are cells everywhere.
    ``reason`` says why a page gives no statement and is null for a good page.
    """
    kept = [c for c in pages.columns if c != "html"]
    kinds = ("td",) if header_cells_anywhere else ("td", "th")
    # Both Python steps read the table as it is found, so that they run side by side.
    inner = nested_rows(F.when(F.col("_nested"), F.col("_table")), kinds, ("th",), _rare_decoder())
    found = (
        _with_table(pages, section_id)
        .withColumns({"_table": decode_rare_entities(F.col("_table")), "_deep": inner})
        .withColumn("_rows", _open_elements(F.col("_table"), "tr", _NEXT_ROW))
    )
    cell_tag = "td" if header_cells_anywhere else "t[hd]"
    head = (
        _open_elements(F.col("_table"), "th", _NEXT_CELL)
        if header_cells_anywhere
        else _open_elements(F.coalesce(F.get("_rows", F.lit(0)), F.lit("")), "t[hd]", _NEXT_CELL)
    )
    body = F.transform(
        F.slice("_rows", F.lit(2), F.greatest(F.size("_rows") - 1, F.lit(0))),
        lambda row, i: F.struct(
            (i + 1).cast("int").alias("row_idx"),
            F.transform(_open_elements(row, cell_tag, _NEXT_CELL), cell_text).alias("cells"),
        ),
    )
    reason = (
        F.when(F.col("html").isNull(), "not_loaded")
        .when(F.col("_section") == "", "no_section")
        .when(F.col("_table") == "", "no_table")
        .when(F.size("_rows") < 2, "empty_table")
    )
    nested, deep_rows = F.col("_nested"), F.col("_deep.rows")
    deep_head = F.col("_deep.head") if header_cells_anywhere else F.get(deep_rows, F.lit(0))
    deep_body = F.transform(
        F.slice(deep_rows, F.lit(2), F.greatest(F.size(deep_rows) - 1, F.lit(0))),
        lambda cells, i: F.struct((i + 1).cast("int").alias("row_idx"), F.transform(cells, cell_text).alias("cells")),
    )
    head = F.transform(F.when(nested, deep_head).otherwise(head), cell_text)
    body = F.when(nested, deep_body).otherwise(body)
    # Without body rows header and body are empty, so such a page unfolds to nothing.
    usable = reason.isNull()
    shown = F.when(usable, head).otherwise(F.array().cast("array<string>"))
    held = F.when(usable, body).otherwise(F.array().cast("array<struct<row_idx: int, cells: array<string>>>"))
    return found.select(*kept, shown.alias("header"), held.alias("body"), reason.alias("reason"))


def rejected_pages(tables: DataFrame) -> DataFrame:
    reasons = tables.select("page_id", F.explode_outer(F.array_compact(F.array("reason"))).alias("reason"))
    return reasons.where(F.col("reason").isNotNull()).select(
        F.lit("pages").alias("source"),
        F.col("page_id").cast("string").alias("key"),
        "reason",
        F.lit(None).cast("string").alias("raw"),
    )


def table_rows(tables: DataFrame) -> DataFrame:
    """Body rows one by one, with the width the header asks for."""
    rows = tables.select("page_id", F.size("header").alias("n_header"), F.inline_outer("body"))
    return rows.where(F.col("row_idx").isNotNull()).select("page_id", "row_idx", "n_header", "cells")


def fits_header(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("cells") == F.col("n_header"))


def misfits(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("cells") != F.col("n_header"))


def drop_last_cells(cells: Column, n: int) -> Column:
    return F.slice(cells, F.lit(1), F.greatest(F.size(cells) - n, F.lit(0)))


def _picked(tables: DataFrame, metrics: list[str], drop_last: int, label_mark: str) -> tuple[DataFrame, Column]:
    """Per page the periods and, per metric, its cells; with the array that unfolds to periods.

    A metric without a row has empty cells. One whose row doesn't fit the header has null cells:
    which of them belongs where can't be known.
    """
    width = F.size("header")
    rows = F.transform(
        F.filter("body", lambda r: ~F.contains(F.coalesce(F.get(r["cells"], F.lit(0)), F.lit("")), F.lit(label_mark))),
        lambda r: F.struct(
            normalize_header(F.get(r["cells"], F.lit(0))).alias("metric"),
            F.when(
                F.size(r["cells"]) == width,
                drop_last_cells(F.slice(r["cells"], F.lit(2), F.greatest(width - 1, F.lit(0))), drop_last),
            ).alias("cells"),
        ),
    )
    periods = drop_last_cells(F.slice("header", F.lit(2), F.greatest(width - 1, F.lit(0))), drop_last)
    shaped = tables.withColumns({"_periods": periods, "_rows": rows}).withColumn("_labels", F.col("_rows.metric"))

    def cells_of(metric: str) -> Column:
        place = F.array_position("_labels", metric)
        nothing = F.array_repeat(F.lit(""), F.size("_periods"))
        lost = F.array_repeat(F.lit(None).cast("string"), F.size("_periods"))
        found = F.get("_rows", (place - 1).cast("int"))["cells"]
        return F.when(place == 0, nothing).otherwise(F.coalesce(found, lost))

    picked = shaped.withColumns({f"_m{i}": cells_of(m) for i, m in enumerate(metrics)})
    return picked, F.arrays_zip("_periods", *[f"_m{i}" for i in range(len(metrics))])


def transpose_statement(
    tables: DataFrame,
    metrics: list[str] = SCRAPED,
    drop_last: int = 0,
    label_mark: str = LABEL_MARK,
) -> DataFrame:
    """Metric-by-period tables turned into one row per period, one text column per metric.

    Each metric's cells are picked once as an array; zipping the arrays with the periods is the
    transposition. ``pos`` numbers the periods of a page from 1 in document order.
    """
    kept = [c for c in tables.columns if c not in ("header", "body", "reason")]
    picked, zipped = _picked(tables, metrics, drop_last, label_mark)
    unfolded = picked.select(*kept, F.posexplode_outer(zipped).alias("_i", "_z"))
    return unfolded.where(F.col("_i").isNotNull()).select(
        *kept,
        (F.col("_i") + 1).alias("pos"),
        F.col("_z._periods").alias(YEAR),
        *[F.col(f"_z._m{i}").alias(m) for i, m in enumerate(metrics)],
    )


REJECTS = "array<struct<reason: string, raw: string>>"


def read_statements(
    pages: DataFrame, metrics: list[str] = SCRAPED, label_mark: str = LABEL_MARK, allow_negative: bool = True
) -> DataFrame:
    """Facts and rejects of pages from one reading: page_id, url, pos, Year, metrics, rejects.

    A page has a row for each period, with the cells of that period that are no number, and a row
    of ``pos`` 0 with what concerns the whole page: why it gives no statement, rows that don't fit
    the header, labels that are no metric. ``facts_of`` and ``rejects_of`` take the two apart;
    store the frame first, so that pages are parsed once.
    """
    tables = statement_tables(pages)
    picked, zipped = _picked(tables, metrics, 0, label_mark)
    width, label = F.size("header"), lambda r: F.coalesce(F.get(r["cells"], F.lit(0)), F.lit(""))
    told = lambda reason, raw: F.struct(F.lit(reason).alias("reason"), raw.alias("raw"))
    ragged = F.transform(
        F.filter("body", lambda r: F.size(r["cells"]) != width),
        lambda r: told("ragged_row", F.array_join(r["cells"], "|")),
    )
    unknown = F.transform(
        F.filter(
            "body",
            lambda r: (F.size(r["cells"]) == width)
            & ~F.contains(label(r), F.lit(label_mark))
            & ~normalize_header(label(r)).isin(metrics),
        ),
        lambda r: told("unknown_metric", label(r)),
    )
    whole = F.array(F.struct("reason", F.lit(None).cast("string").alias("raw"))).cast(REJECTS)
    page = F.when(F.col("reason").isNotNull(), whole).otherwise(F.concat(ragged.cast(REJECTS), unknown.cast(REJECTS)))
    kind = picked.select(zipped.alias("z")).schema["z"].dataType.elementType
    lead = F.array(F.lit(None).cast(kind))
    unfolded = picked.select("page_id", "url", page.alias("_page"), F.posexplode(F.concat(lead, zipped)).alias("pos", "_z"))
    texts = unfolded.select(
        "page_id",
        "url",
        "pos",
        F.when(F.col("pos") == 0, F.col("_page")).alias("_page"),
        F.col("_z._periods").alias(YEAR),
        *[number_text(F.col(f"_z._m{i}")).alias(m) for i, m in enumerate(metrics)],
        *[F.col(f"_z._m{i}").alias(f"_raw{i}") for i in range(len(metrics))],
    )
    values = {m: number_value(F.col(f"`{m}`"), allow_negative) for m in metrics}
    bad = F.array(
        *[
            F.when(F.col(f"_raw{i}").isNotNull() & values[m].isNull(), told(f"not_a_number:{m}", F.col(f"_raw{i}")))
            for i, m in enumerate(metrics)
        ]
    )
    return texts.select(
        "page_id",
        "url",
        "pos",
        YEAR,
        *[v.alias(SCRAPED_TO_METRIC[m]) for m, v in values.items()],
        F.when(F.col("pos") == 0, F.col("_page")).otherwise(F.array_compact(bad).cast(REJECTS)).alias("rejects"),
    )


def facts_of(read: DataFrame, skip_period: str | None = TRAILING_PERIOD) -> DataFrame:
    facts = read.where("pos > 0")
    if skip_period is not None:
        facts = facts.where(~F.col(YEAR).eqNullSafe(F.lit(skip_period)))
    return facts.select(YEAR, *METRICS, page_key(F.col("url")).alias("Company_id"))


def rejects_of(read: DataFrame) -> DataFrame:
    key = F.concat_ws("/", F.col("page_id").cast("string"), F.when(F.col("pos") > 0, F.col(YEAR)))
    return read.select(F.lit("pages").alias("source"), key.alias("key"), F.inline("rejects"))


def unknown_metrics(tables: DataFrame, metrics: list[str] = SCRAPED, label_mark: str = LABEL_MARK) -> DataFrame:
    """Row labels that are no declared metric; their rows are left out of the statement."""
    rows = fits_header(table_rows(tables)).select("page_id", F.get("cells", F.lit(0)).alias("raw"))
    name = normalize_header(F.col("raw"))
    return rows.where(~F.col("raw").contains(label_mark) & ~name.isin(metrics)).select(
        F.lit("pages").alias("source"),
        F.col("page_id").cast("string").alias("key"),
        F.lit("unknown_metric").alias("reason"),
        "raw",
    )


def clean_statement(
    texts: DataFrame, percent_as_fraction: bool = False, allow_negative: bool = True
) -> DataFrame:
    """Text columns as numbers under the message spelling.

    Empty cells, and those of a metric without a row, are 0.0. Text that is no number, and the
    cells of a row that doesn't fit the header, are null here and listed as rejects.
    """
    found = [c for c in texts.columns if c in SCRAPED_TO_METRIC]
    rest = [c for c in texts.columns if c not in SCRAPED_TO_METRIC]

    def bare(name: str) -> Column:
        text = F.col(f"`{name}`")
        cleaned = number_text(text).alias("bare")
        return F.struct(cleaned, strip_text(text).endswith("%").alias("percent")) if percent_as_fraction else cleaned

    def value(metric: str) -> Column:
        if not percent_as_fraction:
            return number_value(F.col(metric), allow_negative)
        number = number_value(F.col(f"{metric}.bare"), allow_negative)
        return F.when(F.col(f"{metric}.percent"), number / 100).otherwise(number)

    # Two projections, so that each cell's text is cleaned once and then tested.
    cleaned = texts.select(*rest, *[bare(c).alias(SCRAPED_TO_METRIC[c]) for c in found])
    return cleaned.select(*rest, *[value(SCRAPED_TO_METRIC[c]).alias(SCRAPED_TO_METRIC[c]) for c in found])


def rejected_cells(texts: DataFrame, allow_negative: bool = True) -> DataFrame:
    """Cells that hold no number, with their raw text."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("raw"))
            for c in SCRAPED
            if c in texts.columns
        ]
    )
    bad = F.filter(cells, lambda x: x["raw"].isNotNull() & clean_number(x["raw"], allow_negative).isNull())
    return texts.select("page_id", YEAR, F.inline(bad)).select(
        F.lit("pages").alias("source"),
        F.concat_ws("/", F.col("page_id").cast("string"), YEAR).alias("key"),
        F.concat(F.lit("not_a_number:"), F.col("metric")).alias("reason"),
        "raw",
    )


def extract_statements(pages: DataFrame, skip_period: str | None = TRAILING_PERIOD) -> DataFrame:
    """Pages to facts: one row per company and period."""
    texts = transpose_statement(statement_tables(pages)).withColumn("Company_id", page_key(F.col("url")))
    facts = clean_statement(texts)
    if skip_period is not None:
        facts = facts.where(~F.col(YEAR).eqNullSafe(F.lit(skip_period)))
    return facts.select(YEAR, *METRICS, "Company_id")


#: Most metrics that pages may name; more are a sign that labels aren't metrics.
MOST_METRICS = 1000


def page_metrics(tables: DataFrame, label_mark: str = LABEL_MARK) -> DataFrame:
    """The metrics that the pages name: metric, kind, n_pages, n_cells, in the order of their names.

    ``kind`` is the least of ``integer``, ``number`` and ``text`` that holds all the metric's cells on all
    pages; an empty cell is an integer. One aggregate over the rows that fit their header.
    """
    rows = fits_header(table_rows(tables)).where(~F.contains(F.coalesce(F.get("cells", F.lit(0)), F.lit("")), F.lit(label_mark)))
    cells = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))

    def level(text: Column) -> Column:
        bare = number_text(text)
        whole = bare.rlike(r"^-?[0-9]{1,15}\z")
        # Most cells show at once that they are a number and no integer.
        shown = text.rlike(r"^[0-9][0-9,]*\.[0-9]+%?\z")
        return F.when(shown, 1).when(whole, 0).when(number_value(bare).isNotNull(), 1).otherwise(2)

    highest = F.coalesce(F.array_max(F.transform(cells, level)), F.lit(0))
    named = rows.select("page_id", normalize_header(F.get("cells", F.lit(0))).alias("metric"), highest.alias("l"), F.size(cells).alias("n"))
    kinds = F.array(*[F.lit(k) for k in ("integer", "number", "text")])
    # Pages are counted per page first, so a page that names a metric twice counts once.
    per_page = named.groupBy("page_id", "metric").agg(F.max("l").alias("l"), F.sum("n").alias("n"))
    found = per_page.groupBy("metric").agg(F.max("l").alias("l"), F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("n_cells"))
    return found.select("metric", F.get(kinds, F.col("l")).alias("kind"), "n_pages", "n_cells")


def stack_statements(
    tables: DataFrame, skip_period: str | None = TRAILING_PERIOD, label_mark: str = LABEL_MARK
) -> DataFrame:
    """Pages with whatever metrics they name, one row per page and period: page_id, url, pos, Year, metrics.

    The metrics are found by ``page_metrics`` and are columns in the order of their names, each of the kind
    that holds all its cells: bigint, double, or text without commas. An empty cell, and a metric that a
    page lacks, is 0, or empty text; the cells of a row that doesn't fit its header are null. Pages are
    parsed twice, so store ``tables`` first where that is dear.
    """
    found = sorted((r.metric, r.kind) for r in page_metrics(tables, label_mark).limit(MOST_METRICS + 1).collect())
    if len(found) > MOST_METRICS:
        raise ValueError(f"pages name more than {MOST_METRICS} metrics")
    texts = transpose_statement(tables, [m for m, _ in found], 0, label_mark)
    rest = [c for c in texts.columns if c not in {m for m, _ in found}]
    if skip_period is not None:
        texts = texts.where(~F.col(YEAR).eqNullSafe(F.lit(skip_period)))

    def value(name: str, kind: str) -> Column:
        text = F.col(f"`{name}`")
        if kind == "text":
            return F.when(text != "", number_text(text)).otherwise(text)
        number = number_value(number_text(text))
        return number.cast("long") if kind == "integer" else number

    return texts.select(*rest, *[value(m, k).alias(m) for m, k in found])

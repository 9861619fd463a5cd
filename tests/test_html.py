from pyspark.sql import functions as F

from tallystream.operators import html as H
from tallystream.schemas import METRICS, SCRAPED, YEAR

PAGE = """<html><!-- <section id="profit-loss"><table><tr><th>no</th></tr></table></section> -->
<script>var s = '<section id="profit-loss">';</script>
<section id="quarters"><table><tr><th></th><th>Jun 2024</th></tr><tr><td>Sales</td><td>9</td></tr></table></section>
<SECTION class="card" ID='profit-loss' data-x="1"><h2>P&amp;L</h2>
<table class="data">
<thead><tr><th></th><th>Mar 2023</th>
<th>Mar 2024</th><th>TTM</th></tr></thead>
<tr><td class="text">Sales&nbsp;<span>+</span></td><td>1,234</td><td> 2,000.5 </td><td>3</td></tr>
<tr><td>OPM %</td><td>25%</td><td>-3%</td><td>1%</td></tr>
<tr><td>Tax %</td><td>n/a</td><td>5-3</td><td></td></tr>
<tr><td>Interest</td><td>1</td><td>2</td></tr>
<tr><td>TTL sum</td><td>7</td><td>7</td><td>7</td></tr>
<tr><td>Depreciation</td><td></td><td>1&#48;</td><td>1&comma;0</td></tr>
<tr><td>R&amp;D &lt;net&gt;</td><td>1</td><td>2</td><td>3</td></tr>
<tr><td>EPS in Rs</td><td>&amp;lt;</td><td>.5</td><td>1</td></tr>
</table><table><tr><th>second</th></tr></table></section></html>"""

URL = "https://x.example.org/company/M&M/consolidated/"


def pages(spark, *htmls):
    return spark.createDataFrame([(i, URL, h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def test_table_rows_and_arity(spark):
    rows = H.table_rows(H.statement_tables(pages(spark, PAGE)))
    got = {r.row_idx: (r.n_header, r.cells) for r in rows.collect()}
    assert got[1] == (4, ["Sales +", "1,234", "2,000.5", "3"])
    assert got[6] == (4, ["Depreciation", "", "10", "1,0"])
    assert got[7][1][0] == "R&D <net>"
    assert got[8][1][1] == "&lt;"
    assert [r.row_idx for r in H.misfits(rows).collect()] == [4]
    assert H.fits_header(rows).count() == 7


def test_both_kinds_of_cells(spark):
    html = '<section id="profit-loss"><table><tr><th></th><td>A</td><td>B</td></tr><tr><th>Sales</th><td>1</td><td>2</td></tr></table></section>'
    tables = H.statement_tables(pages(spark, html), header_cells_anywhere=False)
    assert tables.first().header == ["", "A", "B"]
    assert tables.first().body[0].cells == ["Sales", "1", "2"]


def test_transpose_and_clean(spark):
    tables = H.statement_tables(pages(spark, PAGE))
    texts = H.transpose_statement(tables).orderBy("pos")
    assert texts.columns == ["page_id", "url", "pos", YEAR, *SCRAPED]
    assert [(r.pos, r[YEAR], r.Sales, r.Interest) for r in texts.collect()] == [
        (1, "Mar 2023", "1,234", None),
        (2, "Mar 2024", "2,000.5", None),
        (3, "TTM", "3", None),
    ]
    facts = H.clean_statement(texts)
    first, second, third = facts.collect()
    assert (first.Sales_plus, second.Sales_plus, third.Sales_plus) == (1234.0, 2000.5, 3.0)
    assert (first.OPM_percent, second.OPM_percent) == (25.0, -3.0)
    assert (first.Tax_percent, second.Tax_percent, third.Tax_percent) == (None, 0.0, 0.0)
    assert (first.Interest, first.Depreciation, second.Depreciation) == (None, 0.0, 10.0)
    fractions = H.clean_statement(texts, percent_as_fraction=True).collect()
    assert [r.OPM_percent for r in fractions] == [0.25, -0.03, 0.01]


def test_rejected_cells_and_labels(spark):
    tables = H.statement_tables(pages(spark, PAGE))
    cells = H.rejected_cells(H.transpose_statement(tables)).collect()
    assert {(r.key, r.reason, r.raw) for r in cells} == {
        ("0/Mar 2023", "not_a_number:Tax_%", "n/a"),
        ("0/Mar 2023", "not_a_number:EPS_in_Rs", "&lt;"),
    }
    assert [tuple(r) for r in H.unknown_metrics(tables).collect()] == [("pages", "0", "unknown_metric", "R&D <net>")]


def test_rejected_pages(spark):
    df = pages(
        spark,
        PAGE,
        "<html><p>gone</p></html>",
        '<section id="profit-loss"><p>soon</p></section>',
        '<section id="profit-loss"><table><tr><th></th><th>Mar 2023</th></tr></table></section>',
        None,
        '<section id="profit-loss-2"><table></table></section>',
    )
    tables = H.statement_tables(df)
    got = {r.key: r.reason for r in H.rejected_pages(tables).collect()}
    assert got == {"1": "no_section", "2": "no_table", "3": "empty_table", "4": "not_loaded", "5": "no_section"}
    assert [r.page_id for r in H.transpose_statement(tables).select("page_id").distinct().collect()] == [0]
    assert [r.page_id for r in H.table_rows(tables).select("page_id").distinct().collect()] == [0]


def test_extract_statements(spark):
    facts = H.extract_statements(pages(spark, PAGE))
    assert facts.columns == [YEAR, *METRICS, "Company_id"]
    assert [(r[YEAR], r.Company_id) for r in facts.orderBy(YEAR).collect()] == [("Mar 2023", "M&M"), ("Mar 2024", "M&M")]


def test_drop_last_periods(spark):
    texts = H.transpose_statement(H.statement_tables(pages(spark, PAGE)), drop_last=2)
    assert [r[YEAR] for r in texts.collect()] == ["Mar 2023"]


def test_rare_entities(spark):
    df = spark.createDataFrame([("caf&eacute; &#x41;&#60;b&#62; &unknown; &amp;copy; a & b",), ("plain",), (None,)], "t string")
    got = [r.t for r in df.select(H.cell_text(H.decode_rare_entities(F.col("t"))).alias("t")).collect()]
    assert got == ["café A<b> &unknown; &copy; a & b", "plain", None]


def test_list_items(spark):
    html = "<nav><ul><li> One <b>x</b></li><li>Two&copy;</li></ul></nav><nav><li>No</li></nav>"
    rows = H.list_items(pages(spark, html, "<p></p>")).collect()
    assert [(r.page_id, r.item_idx, r.text) for r in rows] == [(0, 0, "One x"), (0, 1, "Two©")]


def test_page_key(spark):
    df = spark.createDataFrame([(URL,), ("https://x.example.org/about/",), (None,)], "u string")
    assert [r.k for r in df.select(H.page_key(F.col("u")).alias("k")).collect()] == ["M&M", None, None]


def test_extraction_needs_no_shuffle_and_reads_each_page_once(spark):
    plan = H.clean_statement(H.transpose_statement(H.statement_tables(pages(spark, PAGE))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1 and text.count("<section") == 1 and text.count(r"\A.*?(?=<table") == 1


LOOSE = """<section id="profit-loss"><section class="tabs"><p>x</p></section>
<table><tr><th><th>Mar 2023<th>Mar 2024
<tr><td>Sales<td>1<td>2</tr>
<tr><td>Interest<td>3</td></tr>
<tr><td>Tax %</td><td>n/a</td><td>5</td></tr>
<tr><td>Odd</td><td>1</td><td>2</td></tr></table></section>"""


def test_inner_sections_and_open_cells_are_read(spark):
    row = H.statement_tables(pages(spark, LOOSE)).first()
    assert row.header == ["", "Mar 2023", "Mar 2024"] and row.reason is None
    assert [b.cells for b in row.body] == [["Sales", "1", "2"], ["Interest", "3"], ["Tax %", "n/a", "5"], ["Odd", "1", "2"]]


def test_a_table_after_the_section_is_no_statement(spark):
    df = pages(spark, '<section id="profit-loss"><section></section></section><table><tr><th>A<tr><td>1</table>')
    assert [r.reason for r in H.statement_tables(df).collect()] == ["no_table"]


INNER = """<section id="profit-loss"><table class=a><tr><th>x</th><th>Mar 2023</th></tr>
<tr><td>Sales</td><td>1 <b>2</b></td></tr>
<tr><td>Notes<TABLE><tr><td>a</td><td>b &amp; c<table><tr><td>deep</td></tr></table>tail</td></tr><tr><th>inner</th></tr></TABLE></td><td>end</td></tr>
<tr><td>Interest</td><td>3</td></tr></table><table><tr><td>second</td></tr></table></section>"""


def reference_reading(markup, header_anywhere=True):
    """Cells of rows as a tree parser finds them: all descendants, in document order."""
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.root = ("root", [])
            self.stack = [self.root]

        def handle_starttag(self, tag, attrs):
            node = (tag, [])
            self.stack[-1][1].append(node)
            self.stack.append(node)

        def handle_endtag(self, tag):
            while len(self.stack) > 1 and self.stack.pop()[0] != tag:
                pass

        def handle_data(self, data):
            self.stack[-1][1].append(data)

    def walk(node, kinds):
        for child in node[1]:
            if not isinstance(child, str):
                if child[0] in kinds:
                    yield child
                yield from walk(child, kinds)

    def text(node):
        return "".join(c if isinstance(c, str) else text(c) for c in node[1])

    tree = Tree()
    tree.feed(markup)
    table = next(walk(tree.root, ("table",)))
    rows = list(walk(table, ("tr",)))
    kinds = ("td",) if header_anywhere else ("td", "th")
    cells = [[text(c).strip() for c in walk(r, kinds)] for r in rows]
    return ([text(c).strip() for c in walk(table, ("th",))] if header_anywhere else cells[0]), cells[1:]


def test_tables_in_cells_are_read_as_a_tree_parser_does(spark):
    again = INNER.replace("<td>Interest</td><td>3</td>", "<td><table><tr><td>Interest</td></tr></table></td><td>3</td>")
    for markup in (INNER, again, INNER.replace("end", "<table></table>")):
        for anywhere in (True, False):
            row = H.statement_tables(pages(spark, markup), header_cells_anywhere=anywhere).first()
            assert row.reason is None
            assert (row.header, [b.cells for b in row.body]) == reference_reading(markup, anywhere)
            assert [b.row_idx for b in row.body] == list(range(1, len(row.body) + 1))


def test_rows_of_inner_tables_are_rows(spark):
    header = "<th>y</th>" * 0
    tables = H.statement_tables(pages(spark, INNER.replace("<tr><th>inner</th></tr>", header)))
    texts = H.transpose_statement(tables).collect()
    assert [(r[YEAR], r.Sales, r.Interest) for r in texts] == [("Mar 2023", "1 2", "3")]


def test_inner_tables_with_open_tags(spark):
    df = pages(
        spark,
        '<section id="profit-loss"><table><tr><th>A<tr><td><table><tr><td>1</table></table></section>',
        '<section id="profit-loss"><table><tr><th>A<th>B<tr><td>1<td><table><tr><td>x<td>y</table>z<tr><td>2<td>3</table><table></table></section>',
        '<section id="profit-loss"><table><tr><th>A<tr><td><table><tr><td>1</table>rest</section>',
    )
    found = [(r.header, [b.cells for b in r.body], r.reason) for r in H.statement_tables(df).orderBy("page_id").collect()]
    assert found == [
        (["A"], [["1", "1"], ["1"]], None),
        (["A", "B"], [["1", "xyz", "x", "y"], ["x", "y"], ["2", "3"]], None),
        (["A"], [["1", "1"], ["1"]], None),
    ]


def test_time_of_inner_tables_grows_with_their_tags(spark):
    import time

    rows = "".join(f"<tr><td>m{i}<td>{i}<td>1<td>2" for i in range(8000))
    html = f'<section id="profit-loss"><table><tr><th>A{rows}<tr><td><table><tr><td>in&eacute;r</table></table></section>'
    began = time.time()
    row = H.statement_tables(pages(spark, html)).first()
    # Some 32,000 cells; with a fold per cell 800 rows took 7 s, and the time grew with their square.
    assert time.time() - began < 30
    assert len(row.body) == 8002 and row.body[7999].cells == ["m7999", "7999", "1", "2"]
    assert [b.cells for b in row.body[8000:]] == [["inér", "inér"], ["inér"]]


def own_page(*rows):
    head = "<tr><th></th><th>Mar 2023</th><th>TTM</th></tr>"
    body = "".join(f"<tr><td>{label}</td><td>{a}</td><td>{b}</td></tr>" for label, a, b in rows)
    return f'<section id="profit-loss"><table>{head}{body}</table></section>'


def test_metrics_found_on_the_pages(spark):
    df = pages(
        spark,
        own_page(("Sales&nbsp;<b>+</b>", "1,000", "2"), ("Net Interest Income", "1.5", ""), ("Rating", "", ""), ("TTL", "1", "2")),
        own_page(("Sales", "7", "8"), ("Rating", "AA, stable", "9"), ("Branches", "12", ""), ("Branches", "1", "2")),
        "<p></p>",
    )
    tables = H.statement_tables(df)
    found = {r.metric: (r.kind, r.n_pages, r.n_cells) for r in H.page_metrics(tables).collect()}
    assert found == {
        "Sales": ("integer", 2, 4), "Net_Interest_Income": ("number", 1, 2), "Rating": ("text", 2, 4), "Branches": ("integer", 1, 4),
    }
    stacked = H.stack_statements(tables)
    assert stacked.columns == ["page_id", "url", "pos", YEAR, "Branches", "Net_Interest_Income", "Rating", "Sales"]
    assert [k for _, k in stacked.dtypes[4:]] == ["bigint", "double", "string", "bigint"]
    rows = sorted(tuple(r)[0:1] + tuple(r)[3:] for r in stacked.collect())
    assert rows == [(0, "Mar 2023", 0, 1.5, "", 1000), (1, "Mar 2023", 12, 0.0, "AAstable", 7)]
    assert H.stack_statements(tables, skip_period=None).count() == 4
    assert H.stack_statements(H.statement_tables(pages(spark, "<p></p>"))).collect() == []


def test_too_many_metrics(spark, monkeypatch):
    monkeypatch.setattr(H, "MOST_METRICS", 1)
    import pytest

    with pytest.raises(ValueError, match="more than 1"):
        H.stack_statements(H.statement_tables(pages(spark, own_page(("A", "1", "2"), ("B", "1", "2")))))


def test_facts_and_rejects_from_one_reading(spark):
    df = pages(spark, LOOSE, "<p></p>", None, PAGE)
    read = H.read_statements(df)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") == 1
    facts = H.facts_of(read).where("Company_id is not null").collect()
    assert sorted((r[YEAR], r.Sales_plus, r.Interest, r.Tax_percent, r.Depreciation) for r in facts)[0::2][0:1] == [
        ("Mar 2023", 1.0, None, None, 0.0)
    ]
    rejects = {(r.key, r.reason, r.raw) for r in H.rejects_of(read).collect() if not r.key.startswith("3")}
    assert rejects == {
        ("0", "ragged_row", "Interest|3"),
        ("0", "unknown_metric", "Odd"),
        ("0/Mar 2023", "not_a_number:Tax_%", "n/a"),
        ("1", "no_section", None),
        ("2", "not_loaded", None),
    }
    same = [tuple(r) for r in H.extract_statements(df).orderBy("Company_id", YEAR, "Sales_plus").collect()]
    assert same == [tuple(r) for r in H.facts_of(read).orderBy("Company_id", YEAR, "Sales_plus").collect()]


def test_plain_cells_and_others_read_the_same(spark):
    texts = ["", "1,234.5%", "a b", " a", "a ", "a\n", "a\u00a0", "\x1ca", "a>b", "a;b", "&amp;", "<b>x</b> ", "\u3000é", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(H.cell_text(F.col("t")).alias("t")).collect()
    assert [r.t for r in got] == ["", "1,234.5%", "a b", "a", "a", "a", "a", "a", "a>b", "a;b", "&", "x", "é", None]


def test_pages_are_written_without_lambdas(spark):
    from unittest import mock

    from tallystream.plans import bindings as B

    frames = {n: spark.range(9).select(F.from_json(F.lit(""), B.TABLES[n]).alias("r")).select("r.*") for n in ("lineitem", "orders")}
    with mock.patch.object(B, "table", lambda spark, sf_dir, name: frames[name]):
        plan = B.statement_pages(spark, "")._jdf.queryExecution().analyzed().toString()
    assert "lambda" not in plan

"""Operator inputs built from the test tables.

The test tables hold no statements, so change logs come from ``events``, preloaded targets from
``customer``, facts from ``lineitem`` and ``orders``, and statement pages from those facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystream.functions.messages import encode
from tallystream.schemas import AUDIT, COMPANY, METRICS, YEAR

# Declared layouts of the test tables that are read here.
TABLES = {
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
}

# Metrics as functions of an amount v and a small number k; read by Spark and by the oracle.
METRIC_OF_VALUE = {
    "Sales_plus": "v + cast(7.1371 as double)",
    "Expenses_plus": "v * 0.5",
    "Operating_Profit": "v - 3",
    "OPM_percent": "cast(k as double)",
    "Other_Income_plus": "v * 2",
    "Interest": "case when k % 10 = 0 then cast(null as double) else v / 8 end",
    "Depreciation": "v * 0.25",
    "Profit_before_tax": "v + 1",
    "Tax_percent": "v * 0.125",
    "Net_Profit_plus": "v * 17",
    "EPS_in_Rs": "v / 3",
    "Dividend_Payout_percent": "v * 4",
}

# Metrics as functions of the sums of a company's order lines in one year. Amounts are whole
# numbers (price in hundredths, disc and tax in ten-thousandths), so sums are exact.
METRIC_OF_SUMS = {
    "Sales_plus": "price / cast(100 as double)",
    "Expenses_plus": "disc / cast(10000 as double)",
    "Operating_Profit": "(price * 100 - disc) / cast(10000 as double)",
    "OPM_percent": "cast(qty as double)",
    "Other_Income_plus": "tax / cast(10000 as double)",
    "Interest": "cast(n as double)",
    "Depreciation": "n * cast(0.25 as double)",
    "Profit_before_tax": "(price * 100 - disc + tax) / cast(10000 as double)",
    "Tax_percent": "qty * cast(0.5 as double)",
    "Net_Profit_plus": "(price * 100 - disc) / cast(1000000 as double)",
    "EPS_in_Rs": "price / cast(100 as double) / 3",
    "Dividend_Payout_percent": "qty * cast(0.125 as double)",
}

OPERATION_OF_EVENT = (
    "case when event_type in ('signup', 'purchase') then 'INSERT' "
    "when event_type in ('click', 'view') then 'UPDATE' "
    "when event_type = 'error' then 'DELETE' end"
)

LAST_YEAR = 2001  # orders end in this year; it stands for the trailing period
PERIOD_OF_YEAR = f"case when y = {LAST_YEAR} then 'TTM' else concat('Mar ', cast(y as varchar(4))) end"

LABELS = [
    "Sales&nbsp;<span>+</span>",
    "Expenses&nbsp;<span>+</span>",
    "Operating Profit",
    "OPM %",
    "Other Income&nbsp;<span>+</span>",
    "Interest",
    "Depreciation",
    "Profit before tax",
    "Tax %",
    "Net Profit&nbsp;<span>+</span>",
    "EPS in Rs",
    "Dividend Payout %",
]
# The page shows amounts with six decimals; a third of a price has more, so pages use another rule.
PAGE_METRIC = {**METRIC_OF_SUMS, "EPS_in_Rs": "price / cast(100 as double)"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def change_log(source: DataFrame) -> DataFrame:
    """Events, batch or stream, as audit records."""
    k = F.get_json_object("props", "$.k").cast("int")
    flat = source.select(
        "event_id", "ts", "user_id", "event_type", F.col("value").alias("v"), k.alias("k")
    )
    return flat.select(
        F.col("event_id").alias("audit_id"),
        F.expr(OPERATION_OF_EVENT).alias("operation_type"),
        F.col("ts").alias("changed_at"),
        F.lit("loader").alias("changed_by"),
        F.col("user_id").cast("string").alias(YEAR),
        *[F.expr(METRIC_OF_VALUE[m]).alias(m) for m in METRICS],
        F.expr("cast(cast(floor(k / 25) as int) as string)").alias(COMPANY),
    ).select(*AUDIT.names)


def company_log(source: DataFrame) -> DataFrame:
    """The same changes, of which a tenth concern the trailing period."""
    year = F.when(F.col(YEAR).cast("long") % 10 == 3, "TTM").otherwise(F.col(YEAR))
    return change_log(source).withColumn(YEAR, year)


def records(spark: SparkSession, sf_dir: str, company: bool = True) -> DataFrame:
    return encode(change_log(events(spark, sf_dir)), company)


def damaged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which those with a small company number and amount are spoilt in each way."""
    log = change_log(events(spark, sf_dir))
    case = F.col("OPM_percent")  # the small number k
    spoilt = log.withColumns(
        {
            "operation_type": F.when(case == 1, "MERGE").otherwise(F.col("operation_type")),
            YEAR: F.when(case == 2, F.lit(None)).when(case == 3, F.lit("AVERAGE")).otherwise(F.col(YEAR)),
            "Sales_plus": F.when(case == 4, F.lit(0.0)).otherwise(F.col("Sales_plus")),
            "Net_Profit_plus": F.when(case == 5, F.lit(None)).otherwise(F.col("Net_Profit_plus")),
        }
    )
    whole = encode(spoilt)
    text = F.col("value").cast("string")

    def is_case(k: int):
        return text.contains(f'"OPM_percent":{k}.0,')

    value = (
        F.when(is_case(0), F.concat(F.lit("{"), text))
        .when(is_case(6), F.regexp_replace(text, '"changed_at":"[^"]*"', '"changed_at":"garbage"'))
        .when(is_case(7), F.regexp_replace(text, '"Interest":[^,}]*', '"Interest":"abc"'))
        .otherwise(text)
    )
    key = F.when(is_case(8), F.concat(F.lit("x"), F.col("key").cast("string"))).otherwise(F.col("key").cast("string"))
    return whole.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"))


def in_batches(rows: DataFrame, number: str, n: int = 4) -> list[DataFrame]:
    """Batches in no order of time: each row in one of them, every tenth in all of them."""
    return [rows.where((F.pmod(F.xxhash64(number), F.lit(n)) == i) | (F.col(number) % 10 == 0)) for i in range(n)]


def row_versions(source: DataFrame) -> DataFrame:
    """Events, batch or stream, as versions of a user's row; an error removes the row."""
    k = F.get_json_object("props", "$.k").cast("int")
    return source.select(
        F.col("user_id").cast("string").alias(YEAR),
        F.col("event_id").alias("place"),
        F.col("ts").alias("at"),
        (F.col("event_type") == "error").alias("gone"),
        (k % 3).cast("double").alias("Sales_plus"),
        F.when(k % 2 == 0, F.col("event_type")).alias("kind"),
    )


# Read by Spark and by the oracle: an order in its second version, and how often it is there.
ORDER_STATUS = "case when o_orderkey % 5 = 0 then concat(o_orderstatus, '+') else o_orderstatus end"
ORDER_COPIES = "case when o_orderkey % 17 = 0 then 0 when o_orderkey % 23 = 0 then 2 else 1 end"


def order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of a table without a key: a customer has many rows, some of them equal."""
    orders = table(spark, sf_dir, "orders")
    columns = [F.col("o_custkey").cast("string").alias(YEAR), "status", F.year("o_orderdate").alias("y"), "o_orderpriority"]
    old = orders.withColumn("status", F.col("o_orderstatus")).select(*columns)
    copies = F.explode(F.expr(f"array_repeat(0, {ORDER_COPIES})"))
    new = orders.withColumn("status", F.expr(ORDER_STATUS)).withColumn("_copy", copies).select(*columns)
    return old, new


def preloaded(spark: SparkSession, sf_dir: str, company: bool) -> DataFrame:
    """A target that already holds rows, some under keys the log touches.

    With companies four customers share a year, so a key may hold several rows.
    """
    customer = table(spark, sf_dir, "customer")
    base = customer.select(
        F.expr("cast(floor(c_custkey / 4) as bigint)").alias("quarter"),
        "c_custkey",
        F.col("c_acctbal").alias("v"),
        F.col("c_nationkey").alias("k"),
    )
    year = (F.col("quarter") if company else F.col("c_custkey")).cast("string").alias(YEAR)
    columns = [year, *[F.expr(METRIC_OF_VALUE[m]).alias(m) for m in METRICS]]
    if company:
        columns.append(F.expr("cast(k % 4 as string)").alias(COMPANY))
    return base.select(*columns)


def order_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sums per company and year. Lines are summed per order before the join."""

    def hundredths(column: str):
        return F.round(F.col(column) * 100).cast("bigint")

    price = hundredths("l_extendedprice")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(price).alias("price"),
            F.sum(price * hundredths("l_discount")).alias("disc"),
            F.sum(price * hundredths("l_tax")).alias("tax"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("y")
    )
    sums = [F.sum(c).alias(c) for c in ("price", "disc", "tax", "qty", "n")]
    return lines.join(orders, "l_orderkey").groupBy("o_custkey", "y").agg(*sums)


def facts(spark: SparkSession, sf_dir: str, rules: dict[str, str] = METRIC_OF_SUMS) -> DataFrame:
    """One row per company and period."""
    return order_sums(spark, sf_dir).select(
        F.expr(PERIOD_OF_YEAR).alias(YEAR),
        *[F.expr(rules[m]).alias(m) for m in METRICS],
        F.col("o_custkey").cast("string").alias(COMPANY),
        "y",
    )


def _row(label: str, cells) -> list:
    return [F.lit(f'<tr><td class="text">{label}</td>'), F.array_join(cells, ""), F.lit("</tr>\n")]


def statement_pages(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """One page per company. A company has at most one period per calendar year.

    ``damaged`` pages lack a section, a table or its rows, or have a short row, depending on how
    many periods the company has.
    """
    # Cells are written row by row, where the rows of a company meet: lambdas over arrays cost far more.
    rows = facts(spark, sf_dir, PAGE_METRIC).repartition(COMPANY)

    def cell(metric: str):
        tail = "%" if metric.endswith("percent") else ""
        return F.concat(F.lit("<td>"), F.format_number(metric, 6), F.lit(f"{tail}</td>")).alias(metric)

    written = rows.select(COMPANY, "y", F.concat(F.lit("<th>"), YEAR, F.lit("</th>")).alias(YEAR), *[cell(m) for m in METRICS])
    per_company = written.groupBy(COMPANY).agg(F.sort_array(F.collect_list(F.struct("y", YEAR, *METRICS))).alias("p"))

    def cells(metric: str, short=None):
        periods = F.col("p")
        if short is not None:
            periods = F.slice("p", F.lit(1), F.size("p") - F.when(short, 1).otherwise(0))
        return periods[metric]

    n = F.size("p")
    head = F.array_join(F.col("p")[YEAR], "")
    rows = []
    for label, metric in zip(LABELS, METRICS):
        ragged = (n % 2 == 1) if damaged and metric == "Interest" else None
        rows += _row(label, cells(metric, ragged))
    rows += _row("TTL", cells("Sales_plus"))
    table_html = F.concat(F.lit("<table class='data'><thead><tr><th></th>"), head, F.lit("</tr></thead>\n<tbody>"), *rows, F.lit("</tbody></table>"))
    open_tag = F.lit('<section class="card" id="profit-loss"><h2>Profit &amp; Loss</h2>')
    if damaged:
        table_html = F.when(n == 4, F.lit("<p>none</p>")).when(n == 5, F.lit("<table></table>")).otherwise(table_html)
        open_tag = F.when(n <= 3, F.lit('<section id="cash-flow">')).otherwise(open_tag)
    html = F.concat(
        F.lit('<html><body><!-- <section id="profit-loss"></section> -->\n'),
        open_tag,
        table_html,
        F.lit("</section></body></html>"),
    )
    return per_company.select(
        F.col(COMPANY).cast("long").alias("page_id"),
        F.concat(F.lit("https://pages.example.org/company/"), COMPANY, F.lit("/consolidated/")).alias("url"),
        html.alias("html"),
    )


def loose_pages(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """The same pages as loosely written: an inner section before the table, and cells and rows
    left open, the cells on every third page only in part."""
    pages = statement_pages(spark, sf_dir, damaged)
    inner = F.regexp_replace("html", "<table class", '<section class="tabs"><p>Tabs</p></section><table class')
    rows_open = F.replace(inner, F.lit("</tr>"), F.lit(""))
    some = F.replace(rows_open, F.lit("0</td>"), F.lit("0"))
    every = F.replace(rows_open, F.lit("</td>"), F.lit(""))
    return pages.withColumn("html", F.when(F.col("page_id") % 3 == 0, some).otherwise(every))


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages with a row before the sixth in which a cell holds a table."""
    notes = '<tr><td>Notes</td><td><table><tr><td>n1</td><td>n2</td></tr></table></td></tr>'
    at = '<tr><td class="text">Interest'
    return statement_pages(spark, sf_dir).withColumn("html", F.replace("html", F.lit(at), F.lit(notes + at)))


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages with labels of their own: every third names one metric otherwise, every fifth has one more."""
    pages = statement_pages(spark, sf_dir)
    renamed = F.replace("html", F.lit(">Interest<"), F.lit(">Financing Cost +<"))
    renamed = F.when(F.col("page_id") % 3 == 0, renamed).otherwise(F.col("html"))
    cells = F.array_join(F.array_repeat(F.lit("<td>AA, ok</td>"), F.regexp_count("html", F.lit("<th>")) - 1), "")
    row = F.concat(F.lit("<tr><td>Rating</td>"), cells, F.lit("</tr></tbody>"))
    more = F.when(F.col("page_id") % 5 == 1, F.replace(renamed, F.lit("</tbody>"), row)).otherwise(renamed)
    return pages.withColumn("html", more)


CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


# Read by Spark and by the oracle.
ORDER_KEY = "case when o_custkey % 3 = 0 then o_custkey + 1000000000 else o_custkey end"


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of customer rows, with their place in time; a third have other keys."""
    return table(spark, sf_dir, "orders").select(
        F.expr(ORDER_KEY).alias("c_custkey"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.lit(None).cast("int").alias("c_nationkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        "o_orderdate",
        "o_orderkey",
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of a keyed table: rows gone, rows changed, rows new."""

    def shape(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("id").cast("string").alias(YEAR),
            *[F.expr(METRIC_OF_VALUE[m]).alias(m) for m in METRICS],
            F.col("seg").alias(COMPANY),
        )

    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("v"),
        F.col("c_nationkey").alias("k"),
        F.col("c_mktsegment").alias("seg"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("id"),
        F.col("s_acctbal").alias("v"),
        F.col("s_nationkey").alias("k"),
        F.lit("SUPPLY").alias("seg"),
    )
    changed = customer.where("v >= 0").withColumn("v", F.when(F.col("k") < 5, F.col("v") + 1).otherwise(F.col("v")))
    return shape(customer), shape(changed.unionByName(supplier))


# Text in all the shapes of a scraped cell; read by Spark and by the oracle.
CELL_TEXT = """
case l_linenumber
  when 1 then concat(substr(p, 1, length(p) - 6), ',', right(p, 6))
  when 2 then concat(q, '%')
  when 3 then concat('-', q, ' %')
  when 4 then concat(q, '-', l_returnflag)
  when 5 then concat(q, '-', q)
  when 6 then case when l_linestatus = 'O' then '' else concat('.', q) end
  else concat(l_returnflag, q)
end
"""


def cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_returnflag",
        "l_linestatus",
        F.expr("cast(cast(l_extendedprice as decimal(12,2)) as string)").alias("p"),
        F.expr("cast(cast(l_quantity as int) as string)").alias("q"),
    )
    return lines.withColumn("txt", F.expr(CELL_TEXT))

"""One query per operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystream.functions import messages as M
from tallystream.functions.clean import (
    normalize_header,
    number_text,
    number_value,
    parse_mark,
    percent_fraction,
)
from tallystream.functions.derive import derive_profit
from tallystream.operators import audit as A
from tallystream.operators import bag_diff as D
from tallystream.operators import html as H
from tallystream.operators import keyed as K
from tallystream.operators import layout as L
from tallystream.operators import summary as S
from tallystream.operators.fold import BAG, IGNORE, apply_changes
from tallystream.operators.joins import key_list, only_keys
from tallystream.plans import bindings as B
from tallystream.schemas import COMPANY, METRICS, SCRAPED, SINK_MULTI, SINK_SINGLE, YEAR
from tallystream.session import apply_settings, fresh_dir, settle
from tallystream.sources import tables as R
from tallystream.sources.change_log import ChangeLog
from tallystream.sources.polled import PolledAudit
from tallystream.streaming import capture as C
from tallystream.streaming import jobs as J

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MARK = "2024-01-15T00:00:00+00:00"
CLOCK = "2024-02-01T06:30:00.000001+00:00"


def query(fn: Query) -> Query:
    """Register a query under its function's name, less a trailing underscore."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return run


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.facts(spark, sf_dir).drop("y")


# scans, layouts, filters


@query
def table_scan(spark, sf_dir):
    return B.table(spark, sf_dir, "orders")


@query
def head_rows(spark, sf_dir):
    return S.head_rows(B.table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 5)


@query
def schema_conform(spark, sf_dir):
    facts = B.facts(spark, sf_dir)
    as_text = facts.select(YEAR, "y", COMPANY, *[F.col(m).cast("string").alias(m) for m in METRICS[:-1]])
    return L.conform(as_text, SINK_MULTI)


@query
def rename_positional(spark, sf_dir):
    facts = _facts(spark, sf_dir).select(COMPANY, YEAR, *METRICS)
    # The fourteen column names of the third page layout.
    names = [
        "id", "0", "Sales +", "Expenses +", "Operating Profit", "OPM %", "Other Income +", "Interest",
        "Depreciation", "Profit before tax", "Tax %", "Net Profit +", "EPS in Rs", "Dividend Payout %",
    ]
    return L.rename_positional(facts, names)


@query
def rename_map(spark, sf_dir):
    names = {"s_suppkey": "id", "s_name": "month", "s_acctbal": "sales", "Tax %": "tax"}
    return L.rename_map(B.table(spark, sf_dir, "supplier"), names)[0]


@query
def filter_period(spark, sf_dir):
    return K.drop_period(_facts(spark, sf_dir), "TTM")


@query
def filter_label(spark, sf_dir):
    return K.drop_label(B.table(spark, sf_dir, "part"), "p_name", "widget")


@query
def delete_in_list(spark, sf_dir):
    return K.delete_in_list(_facts(spark, sf_dir), YEAR, ["Mar 1995", "Mar 1996"])


@query
def key_list_semijoin(spark, sf_dir):
    wanted = B.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return only_keys(_facts(spark, sf_dir), wanted.select(F.col("c_custkey").cast("string").alias(COMPANY)), [COMPANY])


@query
def key_list_filter(spark, sf_dir):
    """Facts of companies written down in the job."""
    return only_keys(_facts(spark, sf_dir), key_list(spark, COMPANY, [str(k) for k in range(3, 400, 7)]), [COMPANY])


def _texts(spark, sf_dir):
    facts = B.facts(spark, sf_dir)
    odd = F.when(F.col("OPM_percent").cast("long") % 5 == 0, F.concat(F.col("Interest").cast("string"), F.lit(" n/a")))
    as_text = {m: F.col(m).cast("string") for m in METRICS} | {"Interest": F.coalesce(odd, F.col("Interest").cast("string"))}
    return facts.withColumns(as_text).drop(METRICS[-1])


@query
def schema_report(spark, sf_dir):
    return L.layout_report(_texts(spark, sf_dir), SINK_MULTI)


@query
def conform_rejects(spark, sf_dir):
    return L.conform_rejects(_texts(spark, sf_dir), SINK_MULTI, [YEAR, COMPANY])


@query
def fill_metrics(spark, sf_dir):
    log = B.change_log(B.events(spark, sf_dir))
    holed = log.withColumn("Tax_percent", F.when(F.col("OPM_percent") == 7, F.lit(float("nan"))).otherwise(F.col("Tax_percent")))
    return S.fill_metrics(holed.select("audit_id", *METRICS))


# cells and names


@query
def clean_number_(spark, sf_dir):
    bare = B.cell_texts(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "txt", number_text(F.col("txt")).alias("bare")
    )
    valued = bare.select("l_orderkey", "l_linenumber", "txt", "bare", number_value(F.col("bare")).alias("number"))
    return valued.select(
        "l_orderkey",
        "l_linenumber",
        "txt",
        "number",
        (F.col("txt").isNotNull() & F.col("number").isNull()).alias("rejected"),
        number_value(F.col("bare"), allow_negative=False).alias("unsigned_number"),
    )



@query
def percent_fraction_(spark, sf_dir):
    return B.cell_texts(spark, sf_dir).select("l_orderkey", "l_linenumber", percent_fraction(F.col("txt")).alias("fraction"))



def _profiled(spark, sf_dir):
    return B.cell_texts(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.col("q").alias("digits"),
        F.concat("q", F.lit("%")).alias("percent"),
        "p",
    )


@query
def column_profile(spark, sf_dir):
    return S.column_profile(_profiled(spark, sf_dir), ["digits", "percent", "p"], ["l_orderkey", "l_linenumber"])


@query
def profile_conversion(spark, sf_dir):
    return S.convert_by_profile(_profiled(spark, sf_dir), ["digits", "percent", "p"], ["l_orderkey", "l_linenumber"])


@query
def header_normalize(spark, sf_dir):
    name = F.col("p_name")
    hard_space = F.lit("\u00a0")
    label = (
        F.when(F.col("p_size") % 5 == 0, F.concat(name, hard_space, F.lit("+")))
        .when(F.col("p_size") % 5 == 1, F.concat(hard_space, F.lit(" "), name, F.lit(" +")))
        .when(F.col("p_size") % 5 == 2, F.concat(F.col("p_type"), F.lit(" %")))
        .when(F.col("p_size") % 5 == 3, hard_space)
        .otherwise(name)
    )
    return B.table(spark, sf_dir, "part").select(
        "p_partkey",
        normalize_header(label).alias("name"),
        normalize_header(label, F.concat(F.lit("Column_"), F.col("p_size").cast("string"))).alias("numbered"),
    )


@query
def derive_profit_(spark, sf_dir):
    return derive_profit(_facts(spark, sf_dir))



# reshape and aggregates


@query
def unpivot_metrics(spark, sf_dir):
    return S.unpivot_metrics(_facts(spark, sf_dir), [COMPANY, YEAR])


@query
def union_companies(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    recent = facts.where(F.col(YEAR) >= "Mar 1999").drop("Interest", "Dividend_Payout_percent")
    early = facts.where(F.col(YEAR) < "Mar 1999").drop("Tax_percent")
    return S.union_statements([recent, early])


@query
def average_row(spark, sf_dir):
    return S.average_row(_facts(spark, sf_dir))


# pages


@query
def html_list_items(spark, sf_dir):
    return H.list_items(R.read_pages(spark, f"{sf_dir}/pages.parquet"))


@query
def page_key_from_url(spark, sf_dir):
    pages = R.read_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", H.page_key(F.col("url"), r"^https?://[^/]+/([a-z]+)/").alias("page_key"))


@query
def html_table_rows(spark, sf_dir):
    tables = H.statement_tables(B.statement_pages(spark, sf_dir))
    return H.table_rows(tables).select("page_id", "row_idx", "n_header", F.array_join("cells", "|").alias("cells"))


@query
def html_row_arity(spark, sf_dir):
    rows = H.table_rows(H.statement_tables(B.statement_pages(spark, sf_dir, damaged=True)))
    return H.misfits(rows).select(
        "page_id", "row_idx", "n_header", F.size("cells").alias("n_cells"), F.get("cells", F.lit(0)).alias("label")
    )


@query
def html_rejects(spark, sf_dir):
    return H.rejected_pages(H.statement_tables(B.statement_pages(spark, sf_dir, damaged=True)))


@query
def transpose_statement(spark, sf_dir):
    texts = H.transpose_statement(H.statement_tables(B.statement_pages(spark, sf_dir)))
    return H.clean_statement(texts.drop("url"))


@query
def html_loose_rows(spark, sf_dir):
    rows = H.table_rows(H.statement_tables(B.loose_pages(spark, sf_dir)))
    return rows.select("page_id", "row_idx", "n_header", F.array_join("cells", "|").alias("cells"))


@query
def html_nested_rows(spark, sf_dir):
    """Rows of pages in which a cell holds a table."""
    rows = H.table_rows(H.statement_tables(B.nested_pages(spark, sf_dir)))
    return rows.select("page_id", "row_idx", "n_header", F.array_join("cells", "|").alias("cells"))


@query
def statements_from_nested(spark, sf_dir):
    return H.extract_statements(B.nested_pages(spark, sf_dir))


@query
def page_metrics(spark, sf_dir):
    """Metrics that pages with labels of their own name, and what their cells hold."""
    return H.page_metrics(H.statement_tables(B.labelled_pages(spark, sf_dir)))


@query
def stack_statements(spark, sf_dir):
    """Pages with labels of their own, stacked over all metrics that they name."""
    tables = settle(H.statement_tables(B.labelled_pages(spark, sf_dir)))
    stacked = H.stack_statements(tables).drop("url")
    return stacked.toDF(*[c.replace("%", "percent") for c in stacked.columns])


@query
def statements_from_pages(spark, sf_dir):
    return H.extract_statements(B.statement_pages(spark, sf_dir))


@query
def statements_and_rejects(spark, sf_dir):
    """Facts and rejects of loose and damaged pages, from one reading that is stored."""
    read = settle(H.read_statements(B.loose_pages(spark, sf_dir, damaged=True)))
    facts = H.facts_of(read).select(COMPANY, YEAR, "Sales_plus", "Interest", F.lit(None).cast("string").alias("reason"))
    nothing = [F.lit(None).cast("double").alias(m) for m in ("Sales_plus", "Interest")]
    rejects = H.rejects_of(read).select(F.col("key").alias(COMPANY), F.lit(None).cast("string").alias(YEAR), *nothing, "reason")
    return facts.unionByName(rejects)


@query
def period_row_id(spark, sf_dir):
    texts = H.transpose_statement(H.statement_tables(B.statement_pages(spark, sf_dir)))
    return texts.select(F.col("pos").alias("id"), "page_id", YEAR)


@query
def drop_last_periods(spark, sf_dir):
    tables = H.statement_tables(B.statement_pages(spark, sf_dir), header_cells_anywhere=False)
    texts = H.transpose_statement(tables, drop_last=2)
    return H.clean_statement(texts.select("page_id", "pos", YEAR, *SCRAPED), percent_as_fraction=True).select(
        "page_id", "pos", YEAR, "Sales_plus", "Tax_percent"
    )


# keyed writes


def _customers(spark, sf_dir):
    return B.table(spark, sf_dir, "customer")


@query
def keyed_update(spark, sf_dir):
    last = K.last_per_key(B.order_rows(spark, sf_dir), ["c_custkey"], ["o_orderdate", "o_orderkey"])
    return K.keyed_update(_customers(spark, sf_dir), last.select(*B.CUSTOMER), ["c_custkey"])


@query
def keyed_delete(spark, sf_dir):
    return K.keyed_delete(_customers(spark, sf_dir), B.order_rows(spark, sf_dir), ["c_custkey"])


@query
def upsert_ignore(spark, sf_dir):
    return K.upsert_ignore(_customers(spark, sf_dir), B.order_rows(spark, sf_dir), ["c_custkey"], ["o_orderdate", "o_orderkey"])


@query
def upsert_replace(spark, sf_dir):
    return K.upsert_replace(_customers(spark, sf_dir), B.order_rows(spark, sf_dir), ["c_custkey"], ["o_orderdate", "o_orderkey"])


# capture


@query
def snapshot_diff(spark, sf_dir):
    old, new = B.customer_versions(spark, sf_dir)
    clock = F.lit(CLOCK).cast("timestamp")
    return A.snapshot_diff(old, new, [YEAR], clock, F.lit("loader")).drop("audit_id")


@query
def audit_seed(spark, sf_dir):
    clock = F.lit(CLOCK).cast("timestamp")
    seeded = A.audit_seed(_facts(spark, sf_dir), clock, F.lit("loader"), after=41)
    return seeded.withColumn("audit_id", F.col("audit_id") > 41).withColumnRenamed("audit_id", "id_is_new")


@query
def audit_sequence(spark, sf_dir):
    """Ids without gaps, in order of period and company."""
    facts = _facts(spark, sf_dir).repartition(7)
    return A.audit_seed(facts, F.lit(CLOCK).cast("timestamp"), F.lit("loader"), after=41, order=[YEAR, COMPANY])


@query
def bag_diff(spark, sf_dir):
    """Records per key and operation, where keys have several rows."""
    records = D.bag_diff(*B.order_versions(spark, sf_dir), [YEAR])
    key = F.coalesce(f"new.{YEAR}", f"old.{YEAR}").alias(YEAR)
    return records.groupBy(key, "operation_type").agg(F.count(F.lit(1)).alias("n"))


@query
def bag_replay(spark, sf_dir):
    """The second version, from the first and the records between them."""
    old, new = B.order_versions(spark, sf_dir)
    return D.replay_bag(old, D.bag_diff(old, new, [YEAR]))


@query
def bag_to_sink(spark, sf_dir):
    """The second version, from the first and audit records that a sink applies by key."""
    old, new = (
        df.select(YEAR, F.col("y").cast("double").alias("Interest"), F.col("status").alias(COMPANY))
        for df in B.order_versions(spark, sf_dir)
    )
    audit = settle(D.keyed_audit(old, new, [YEAR, COMPANY], F.lit(CLOCK).cast("timestamp"), F.lit("loader")))
    return apply_changes(old, audit, [YEAR, COMPANY], BAG)


@query
def audit_ids(spark, sf_dir):
    """Ids of two captures, the second after the first's largest: how many, how many different, and
    whether all of the second are above all of the first."""
    first = settle(A.audit_seed(_facts(spark, sf_dir), F.lit(CLOCK).cast("timestamp"), F.lit("loader"), after=41))
    top = A.highest_id(first)
    second = A.audit_seed(_facts(spark, sf_dir), F.lit(CLOCK).cast("timestamp"), F.lit("loader"), after=top)
    both = first.select("audit_id", F.lit(1).alias("capture")).unionByName(second.select("audit_id", F.lit(2).alias("capture")))
    return both.groupBy("capture").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("audit_id").alias("n_ids"),
        (F.min("audit_id") > F.when(F.col("capture") == 1, 41).otherwise(top)).alias("above"),
    )


@query
def incremental_scan(spark, sf_dir):
    return A.incremental_scan(B.change_log(B.events(spark, sf_dir)), MARK, ordered=True)


@query
def high_water_mark(spark, sf_dir):
    return A.high_water_mark(B.change_log(B.events(spark, sf_dir)))


@query
def read_high_water(spark, sf_dir):
    kind = F.get_json_object("props", "$.k").cast("int") % 5
    iso = F.date_format("ts", R.ISO)
    text = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.lit("0001-01-01T00:00:00"))
        .when(kind == 2, F.concat(F.lit("at "), iso))
        .when(kind == 3, F.concat(F.lit(" "), iso, F.lit("\n")))
        .otherwise(F.replace(iso, F.lit("+00:00"), F.lit("+05:30")))
    )
    return B.events(spark, sf_dir).select("event_id", parse_mark(text).alias("mark"))


# messages


@query
def message_encode(spark, sf_dir):
    records = B.records(spark, sf_dir)
    fields = ["operation_type", "changed_at", YEAR, *METRICS, COMPANY]
    value = F.col("value").cast("string")
    parsed = records.select(F.col("key").cast("string").alias("key"), F.json_tuple(value, *fields).alias(*fields))
    return parsed.select("key", "operation_type", "changed_at", YEAR, *[F.col(m).cast("double").alias(m) for m in METRICS], COMPANY)


@query
def message_decode(spark, sf_dir):
    return M.decode(B.records(spark, sf_dir, company=False), company=False).select(
        "audit_id", "operation_type", "changed_at", YEAR, *METRICS
    )


@query
def cdc_rejects(spark, sf_dir):
    triaged = M.triage(M.decode(B.damaged_records(spark, sf_dir)))
    return M.rejects(triaged).select("source", "key", "reason")


# applying changes


@query
def cdc_apply_keyed(spark, sf_dir):
    triaged = M.triage(M.decode(B.records(spark, sf_dir, company=False), company=False), company=False)
    # The fold reads the changes twice; the text is parsed once.
    changes = settle(J.prepare(triaged, company=False, skip_periods=[]))
    return apply_changes(B.preloaded(spark, sf_dir, company=False), changes, [YEAR], IGNORE)


@query
def cdc_apply_bag(spark, sf_dir):
    triaged = M.triage(M.decode(B.records(spark, sf_dir)))
    changes = settle(J.prepare(triaged, company=True, skip_periods=["TTM"]))
    target = L.conform(derive_profit(B.preloaded(spark, sf_dir, company=True)), SINK_MULTI)
    return apply_changes(target, changes, [YEAR, COMPANY], BAG)


def _in_batches(spark, sf_dir, company: bool, folds: set[int]) -> ChangeLog:
    """Changes of two writers into a loaded table, in batches that are in no order and overlap."""
    layout, keys, mode = (SINK_MULTI, [YEAR, COMPANY], BAG) if company else (SINK_SINGLE, [YEAR], IGNORE)
    sink = ChangeLog(spark, fresh_dir(spark, "sink"), layout, keys, mode)
    loaded = B.preloaded(spark, sf_dir, company)
    sink.load_initial(L.conform(derive_profit(loaded), SINK_MULTI) if company else loaded)
    for n, batch in enumerate(B.in_batches(B.change_log(B.events(spark, sf_dir)), "audit_id")):
        J.apply_records(sink, M.encode(batch, company), n // 2, "ab"[n % 2], company)
        if n in folds:
            sink.fold()
    return sink


@query
def cdc_apply_any_order(spark, sf_dir):
    """Late and repeated changes, of which half are folded and half are not."""
    return _in_batches(spark, sf_dir, company=False, folds={1}).read()


@query
def cdc_apply_once(spark, sf_dir):
    """Late and repeated changes in a bag, where an insert that counts twice shows."""
    return _in_batches(spark, sf_dir, company=True, folds={0, 2}).read()


@query
def cdc_repeats(spark, sf_dir):
    """How many changes were applied, and how many refused as repeated."""
    sink = _in_batches(spark, sf_dir, company=False, folds={0, 3})
    sums = [F.sum(c).alias(c) for c in ("n_changes", "n_repeated", "n_late")]
    return sink.notes().agg(*sums)


@query
def kept_average(spark, sf_dir):
    """The average moved by the rows that changes concern, from the sums of the last fold."""
    return _in_batches(spark, sf_dir, company=False, folds={1, 2}).average()


@query
def maintained_average(spark, sf_dir):
    return S.average_row(QUERIES["cdc_apply_keyed"](spark, sf_dir))


# streams


def _publish(spark, sf_dir, company: bool, log_of=B.change_log) -> str:
    out = fresh_dir(spark, "records")
    log = log_of(B.events_stream(spark, sf_dir))
    stream = J.publish_stream(log, f"{out}-checkpoint", "parquet", J.AVAILABLE_NOW, company, path=out)
    stream.awaitTermination()
    return out


@query
def cdc_stream_publish(spark, sf_dir):
    published = spark.read.parquet(_publish(spark, sf_dir, company=True))
    return M.decode(published).select("audit_id", "operation_type", "changed_at", YEAR, *METRICS, COMPANY)


def _applied(spark, published: str, sink: ChangeLog, root: str, company: bool) -> None:
    records = spark.readStream.schema("key binary, value binary").parquet(published)
    J.apply_stream(
        records, sink, f"{root}/checkpoint", J.AVAILABLE_NOW, company=company, rejects_path=f"{root}/rejects"
    ).awaitTermination()


@query
def cdc_stream_apply(spark, sf_dir):
    root = fresh_dir(spark, "sink")
    sink = ChangeLog(spark, f"{root}/table", SINK_SINGLE, [YEAR], IGNORE)
    sink.load_initial(B.preloaded(spark, sf_dir, company=False))
    _applied(spark, _publish(spark, sf_dir, company=False), sink, root, company=False)
    return sink.read_with_average()


@query
def cdc_stream_apply_companies(spark, sf_dir):
    """Rows per year and company as a bag, derived columns, the trailing period passed over."""
    root = fresh_dir(spark, "sink")
    sink = ChangeLog(spark, f"{root}/table", SINK_MULTI, [YEAR, COMPANY], BAG)
    sink.load_initial(L.conform(derive_profit(B.preloaded(spark, sf_dir, company=True)), SINK_MULTI))
    _applied(spark, _publish(spark, sf_dir, True, B.company_log), sink, root, company=True)
    sink.fold()
    return sink.read()


@query
def polled_stream_publish(spark, sf_dir):
    """A table that grows between two polls, published by a query whose checkpoint is the mark."""
    spark.dataSource.register(PolledAudit)
    root = fresh_dir(spark, "polled")
    log = B.change_log(B.events(spark, sf_dir))
    edge = F.lit(MARK).cast("timestamp")
    for rows in (log.where(F.col("changed_at") <= edge), log.where(F.col("changed_at") > edge)):
        R.append_table(rows, f"{root}/audit")
        polled = spark.readStream.format("polled_audit").load(f"{root}/audit")
        J.publish_stream(polled, f"{root}/checkpoint", "parquet", J.AVAILABLE_NOW, path=f"{root}/records").awaitTermination()
    published = spark.read.schema("key binary, value binary").parquet(f"{root}/records")
    return M.decode(published).select("audit_id", "operation_type", "changed_at", YEAR, *METRICS, COMPANY)


@query
def capture_stream(spark, sf_dir):
    """A stream of row versions as audit records, from the last image per key."""
    out = fresh_dir(spark, "captured")
    captured = C.capture_stream(B.row_versions(B.events_stream(spark, sf_dir)), [YEAR], "place", "at", "gone")
    stream = captured.writeStream.format("parquet").option("checkpointLocation", f"{out}-checkpoint")
    stream.trigger(**J.AVAILABLE_NOW).start(out).awaitTermination()
    return spark.read.schema(captured.schema).parquet(out)


@query
def capture_versions(spark, sf_dir):
    return C.capture(B.row_versions(B.events(spark, sf_dir)), [YEAR], "place", "at", "gone")


@query
def publish_increment(spark, sf_dir):
    """Two polls: what is older than the mark first, then everything after the stored cursor."""
    root = fresh_dir(spark, "increment")
    log = B.change_log(B.events(spark, sf_dir))
    for audit in (log.where(F.col("changed_at") <= F.lit(MARK).cast("timestamp")), log, log):
        R.publish_increment(audit, f"{root}/mark", "parquet", path=f"{root}/records")
    published = spark.read.schema("key binary, value binary").parquet(f"{root}/records")
    return M.decode(published).select("audit_id", "operation_type", "changed_at", YEAR, *METRICS, COMPANY)


@query
def pages_to_sink(spark, sf_dir):
    """Pages to facts, audit records, messages, and from those to the folded sink."""
    root = fresh_dir(spark, "flow")
    facts = H.facts_of(settle(H.read_statements(B.statement_pages(spark, sf_dir))))
    audit = settle(A.audit_seed(facts, F.lit(CLOCK).cast("timestamp"), F.lit("loader")))
    R.publish_increment(audit, f"{root}/mark", "parquet", path=f"{root}/records")
    sink = ChangeLog(spark, f"{root}/table", SINK_MULTI, [YEAR, COMPANY], BAG)
    _applied(spark, f"{root}/records", sink, root, company=True)
    sink.fold()
    return sink.read()


# sinks


@query
def sink_replace(spark, sf_dir):
    path = fresh_dir(spark, "replace")
    facts = _facts(spark, sf_dir)
    R.replace_table(facts.limit(0), path)
    R.replace_table(facts, path)
    return spark.read.schema(facts.schema).parquet(path)


@query
def sink_append(spark, sf_dir):
    path = fresh_dir(spark, "append")
    facts = _facts(spark, sf_dir)
    R.append_table(K.drop_period(facts, "TTM"), path)
    R.append_table(facts.where(K.period_is("TTM")), path)
    return spark.read.schema(facts.schema).parquet(path)


@query
def company_csv_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "companies")
    customer = _customers(spark, sf_dir)
    R.write_companies(
        customer.select(
            F.concat("c_name", F.lit(', "Ltd." & Co')).alias("Company Name"),
            F.col("c_mktsegment").alias("Industry"),
            F.concat(F.lit("C&"), F.col("c_custkey").cast("string")).alias("Symbol"),
            F.lit("EQ").alias("Series"),
            F.concat(F.lit("INE"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("ISIN Code"),
        ),
        path,
    )
    return R.read_companies(spark, path)


@query
def statement_flow(spark, sf_dir):
    """Flagship: changes encoded, decoded, triaged, applied to a loaded target, average renewed."""
    return S.with_average(settle(QUERIES["cdc_apply_keyed"](spark, sf_dir)))

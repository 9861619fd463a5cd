"""The same results in DuckDB SQL.

The change oracles replay every key's changes one after another in a list fold; they share no
formula with the Spark side.
"""

from __future__ import annotations

from tallystream.plans import bindings as B
from tallystream.schemas import COMPANY, METRICS, SCRAPED, SCRAPED_TO_METRIC, YEAR

CLOCK = "timestamp '2024-02-01 06:30:00.000001'"
_names = ", ".join(METRICS)


def _sql(expression: str) -> str:
    return expression.replace("as string", "as varchar")


def _metrics(rules: dict[str, str]) -> str:
    return ", ".join(f"{_sql(rules[m])} as {m}" for m in METRICS)


LOG = f"""
log as (
  select event_id as audit_id, {B.OPERATION_OF_EVENT} as operation_type, ts as changed_at, 'loader' as changed_by,
    cast(user_id as varchar) as {YEAR}, {_metrics(B.METRIC_OF_VALUE)}, cast(k // 25 as varchar) as {COMPANY}, k
  from (select *, value as v, cast(json_extract_string(props, '$.k') as int) as k from events)
)"""


def _facts(rules: dict[str, str]) -> str:
    return f"""
facts as (
  select {B.PERIOD_OF_YEAR} as {YEAR}, {_metrics(rules)}, cast(o_custkey as varchar) as {COMPANY}, o_custkey, y
  from (
    select o_custkey, year(o_orderdate) as y,
      cast(sum(cast(l_extendedprice as decimal(12,2))) * 100 as bigint) as price,
      cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))) * 10000 as bigint) as disc,
      cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))) * 10000 as bigint) as tax,
      cast(sum(cast(l_quantity as bigint)) as bigint) as qty, count(*) as n
    from lineitem join orders on l_orderkey = o_orderkey
    group by 1, 2
  )
)"""


FACTS = _facts(B.METRIC_OF_SUMS)
PAGE_FACTS = (
    _facts(B.PAGE_METRIC)
    + f""",
numbered as (
  select *, cast(row_number() over (partition by o_custkey order by y) as int) as pos,
    count(*) over (partition by o_custkey) as n_periods
  from facts
)"""
)

CELLS = f"""
cells as (
  select *, {B.CELL_TEXT} as txt from (
    select l_orderkey, l_linenumber, l_returnflag, l_linestatus,
      cast(cast(l_extendedprice as decimal(12,2)) as varchar) as p, cast(cast(l_quantity as int) as varchar) as q
    from lineitem
  )
)"""

_FACT_COLUMNS = f"{YEAR}, {_names}, {COMPANY}"


def _target(company: bool) -> str:
    key = "c_custkey // 4" if company else "c_custkey"
    extra = f", cast(k % 4 as varchar) as {COMPANY}" if company else ""
    return f"""
target as (
  select cast({key} as varchar) as {YEAR}, {_metrics(B.METRIC_OF_VALUE)}{extra}
  from (select c_custkey, c_acctbal as v, c_nationkey as k from customer)
)"""


def _image(names: list[str]) -> str:
    return "struct_pack(" + ", ".join(f"{n} := {n}" for n in names) + ")"


def _replay(keys: list[str], names: list[str], bag: bool) -> str:
    """Changes of a key folded over its rows, in order; needs ``log`` and ``target``."""
    using = ", ".join(keys)
    insert = "list_concat(a.r, b.r)" if bag else "case when len(a.r) > 0 then a.r else b.r end"
    return f"""
changes as (
  select {using}, list(struct_pack(o := operation_type, r := [{_image(names)}]) order by changed_at, audit_id) as l
  from log group by all
),
held as (select {using}, list({_image(names)}) as r from target group by all),
replayed as (
  select {using}, list_reduce(
    coalesce(l, []),
    lambda a, b: struct_pack(o := 'STATE', r := case b.o
      when 'INSERT' then {insert}
      when 'UPDATE' then list_transform(a.r, lambda x: b.r[1])
      when 'DELETE' then b.r[1:0] else a.r end),
    struct_pack(o := 'STATE', r := coalesce(r, []))
  ) as s
  from changes full join held using ({using})
),
applied as (
  select {using}, {", ".join(f"x.{n} as {n}" for n in names)}
  from (select {using}, unnest(s.r) as x from replayed)
)"""


_DERIVE = """
  operating_profit + other_income_plus as total_profit,
  round(net_profit_plus / sales_plus * 100, 2) as net_profit_margin,
  case when net_profit_plus < 1000 then 'Low' when net_profit_plus > 1000 and net_profit_plus < 5000 then 'Medium'
    else 'High' end as profit_category"""

_DERIVED_METRICS = ", ".join("round(EPS_in_Rs, 2) as EPS_in_Rs" if m == "EPS_in_Rs" else m for m in METRICS)

AVERAGE = ", ".join(f"round(avg({m}), 2) as {m}" for m in METRICS)

KEYED = f"with {LOG}, {_target(False)}, {_replay([YEAR], METRICS, False)}"

_SINK = METRICS + ["total_profit", "net_profit_margin", "profit_category"]

_AUDIT_TAIL = f"{CLOCK} as changed_at, 'loader' as changed_by"

_SNAPSHOTS = f"""
old as (
  select cast(id as varchar) as {YEAR}, {_metrics(B.METRIC_OF_VALUE)}, seg as {COMPANY}
  from (select c_custkey as id, c_acctbal as v, c_nationkey as k, c_mktsegment as seg from customer)
),
new as (
  select cast(id as varchar) as {YEAR}, {_metrics(B.METRIC_OF_VALUE)}, seg as {COMPANY}
  from (
    select c_custkey as id, case when c_nationkey < 5 then c_acctbal + 1 else c_acctbal end as v, c_nationkey as k,
      c_mktsegment as seg
    from customer where c_acctbal >= 0
    union all select s_suppkey + 1000000000, s_acctbal, s_nationkey, 'SUPPLY' from supplier
  )
)"""

_ORDERS = f"""
moved as (
  select {B.ORDER_KEY} as c_custkey, 'Order#' || o_orderkey as c_name, cast(null as int) as c_nationkey,
    o_totalprice as c_acctbal, o_orderpriority as c_mktsegment, o_orderdate, o_orderkey
  from orders
),
placed as (
  select *, row_number() over (partition by c_custkey order by o_orderdate, o_orderkey) as up,
    row_number() over (partition by c_custkey order by o_orderdate desc, o_orderkey desc) as down
  from moved
)"""

_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"

_BARE = "trim(replace(replace(replace(replace(txt, '+', ''), '%', ''), ',', ''), ' ', ''))"
_NUMBER = r"regexp_full_match(b, '-?([0-9]+\.?[0-9]*|\.[0-9]+)')"
_MARKS = (
    r"regexp_full_match(b, '[-0-9.]+') and regexp_matches(b, '[0-9]') "
    r"and len(b) - len(replace(b, '.', '')) <= 1 and len(b) - len(replace(b, '-', '')) <= 1"
)

# A page's cell as text, from the number behind it.
_PAGE_CELL = {
    m: f"format('{{:,.6f}}', {m})" + (" || '%'" if m.endswith("percent") else "") for m in METRICS
}
_PAGE_LABEL = [
    "Sales\u00a0+", "Expenses\u00a0+", "Operating Profit", "OPM %", "Other Income\u00a0+", "Interest",
    "Depreciation", "Profit before tax", "Tax %", "Net Profit\u00a0+", "EPS in Rs", "Dividend Payout %",
]


def _page_rows() -> str:
    parts = [
        f"select o_custkey as page_id, {i} as row_idx, cast(count(*) + 1 as int) as n_header, "
        f"'{label}|' || string_agg({_PAGE_CELL[m]}, '|' order by y) as cells from facts group by o_custkey"
        for i, (label, m) in enumerate([*zip(_PAGE_LABEL, METRICS), ("TTL", "Sales_plus")], start=1)
    ]
    return " union all ".join(parts)


def _unpivot() -> str:
    parts = [f"select {COMPANY}, {YEAR}, '{m}' as metric, {m} as v from facts" for m in METRICS]
    return " union all ".join(parts)


def _profile() -> str:
    parts = [
        f"""select '{name}' as "column", bool_and(regexp_full_match({text}, '[0-9]+')) as all_digits,
        contains(arg_min({text}, (l_orderkey, l_linenumber)), '%') as first_has_percent from cells"""
        for name, text in [("digits", "q"), ("percent", "q || '%'"), ("p", "p")]
    ]
    return " union all ".join(parts)


def _exact_average() -> str:
    """Means of exact sums, rounded from the quotient, half away from zero."""
    parts = []
    for m in METRICS:
        units = f"cast(replace(cast(sum(cast({m} as decimal(28,10))) as varchar), '.', '') as hugeint)"
        n = f"(count({m}) * 100000000::hugeint)"
        parts.append(f"cast(sign({units}) * ((2 * abs({units}) + {n}) // (2 * {n})) as double) / 100 as {m}")
    return ", ".join(parts)


_VERSIONS = f"""
versions as (
  select cast(user_id as varchar) as {YEAR}, event_id, ts, event_type = 'error' as gone, cast(k % 3 as double) as Sales_plus,
    case when k % 2 = 0 then event_type end as kind
  from (select *, cast(json_extract_string(props, '$.k') as int) as k from events)
),
placed as (
  select *, lag(event_id) over w as last, lag(gone) over w as was_gone, lag(Sales_plus) over w as old_sales, lag(kind) over w as old_kind
  from versions window w as (partition by {YEAR} order by event_id)
),
captured as (
  select event_id as audit_id, case when gone then 'DELETE' when last is null or was_gone then 'INSERT' else 'UPDATE' end as operation_type,
    ts as changed_at, {YEAR}, case when gone then old_sales else Sales_plus end as Sales_plus,
    case when gone then old_kind else kind end as kind
  from placed
  where case when last is null or was_gone then not gone
    else gone or Sales_plus is distinct from old_sales or kind is distinct from old_kind end
)
select * from captured"""

_BAGS = f"""
old as (
  select cast(o_custkey as varchar) as {YEAR}, o_orderstatus as status, cast(year(o_orderdate) as int) as y, o_orderpriority from orders
),
new as (
  select {YEAR}, status, y, o_orderpriority from (
    select cast(o_custkey as varchar) as {YEAR}, {B.ORDER_STATUS} as status, cast(year(o_orderdate) as int) as y, o_orderpriority,
      unnest(range({B.ORDER_COPIES}))
    from orders)
)"""

ORACLES: dict[str, str] = {
    "table_scan": "select * from orders",
    "head_rows": "select * from orders order by o_orderdate, o_orderkey limit 5",
    "schema_conform": f"""with {FACTS} select {YEAR}, {", ".join(METRICS[:-1])},
        cast(null as double) as {METRICS[-1]}, {COMPANY}, cast(null as double) as total_profit,
        cast(null as double) as net_profit_margin, cast(null as varchar) as profit_category from facts""",
    "rename_positional": f"""with {FACTS} select {COMPANY} as id, {YEAR} as "0", Sales_plus as "Sales +",
        Expenses_plus as "Expenses +", Operating_Profit as "Operating Profit", OPM_percent as "OPM %",
        Other_Income_plus as "Other Income +", Interest, Depreciation, Profit_before_tax as "Profit before tax",
        Tax_percent as "Tax %", Net_Profit_plus as "Net Profit +", EPS_in_Rs as "EPS in Rs",
        Dividend_Payout_percent as "Dividend Payout %" from facts""",
    "rename_map": """select s_suppkey as id, s_name as month, s_nationkey, s_acctbal as sales from supplier""",
    "filter_period": f"with {FACTS} select {_FACT_COLUMNS} from facts where {YEAR} is distinct from 'TTM'",
    "filter_label": "select * from part where not contains(p_name, 'widget')",
    "delete_in_list": f"""with {FACTS} select {_FACT_COLUMNS} from facts
        where {YEAR} is null or {YEAR} not in ('Mar 1995', 'Mar 1996')""",
    "key_list_semijoin": f"""with {FACTS} select {_FACT_COLUMNS} from facts
        where {COMPANY} in (select cast(c_custkey as varchar) from customer where c_mktsegment = 'BUILDING')""",
    "fill_metrics": f"""with {LOG} select audit_id,
        {", ".join(f"case when k = 7 then 0.0 else {m} end as {m}" if m == "Tax_percent"
                   else f"coalesce({m}, 0.0) as {m}" for m in METRICS)} from log""",
    "clean_number": f"""with {CELLS}, bare as (select *, {_BARE} as b from cells)
        select l_orderkey, l_linenumber, txt, number, number is null as rejected,
          case when contains(b, '-') then null else number end as unsigned_number
        from (select *, case when txt = '' then 0.0 when {_NUMBER} then try_cast(b as double)
          when {_MARKS} then 0.0 end as number from bare)""",
    "percent_fraction": f"""with {CELLS},
        bare as (select *, trim(replace(txt, ',', '')) as t, regexp_replace(trim(replace(txt, ',', '')), '%$', '') as b
          from cells)
        select l_orderkey, l_linenumber, case when {_NUMBER} then
          case when t like '%\\%' escape '\\' then cast(b as double) / 100 else cast(b as double) end end as fraction
        from bare""",
    "column_profile": f"with {CELLS} {_profile()}",
    "header_normalize": """with labels as (select p_partkey, p_size, case p_size % 5
          when 0 then p_name || chr(160) || '+' when 1 then chr(160) || ' ' || p_name || ' +'
          when 2 then p_type || ' %' when 3 then chr(160) else p_name end as label from part),
        names as (select *, regexp_replace(regexp_replace(replace(replace(label, ' ', '_'), '+', ''),
          '^[\\s\\x{00A0}]+', ''), '[\\s\\x{00A0}_]+$', '') as n from labels)
        select p_partkey, case when n = '' then 'Unknown' else n end as name,
          case when n = '' then 'Column_' || p_size else n end as numbered from names""",
    "derive_profit": f"with {FACTS} select {YEAR}, {_DERIVED_METRICS}, {COMPANY}, {_DERIVE} from facts",
    "unpivot_metrics": f"with {FACTS} {_unpivot()}",
    "union_companies": f"""with {FACTS} select {YEAR}, {COMPANY},
        {", ".join(
            f"case when {YEAR} >= 'Mar 1999' then 0.0 else {m} end as {m}"
            if m in ("Interest", "Dividend_Payout_percent")
            else f"case when {YEAR} < 'Mar 1999' then 0.0 else {m} end as {m}" if m == "Tax_percent" else m
            for m in METRICS)} from facts""",
    "average_row": f"with {FACTS} select 'AVERAGE' as {YEAR}, {AVERAGE} from facts where {YEAR} not like 'TTM'",
    "html_list_items": """with boxes as (
          select page_id, regexp_extract(
            regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g'),
            '(?is)<nav\\b[^>]*>.*?</nav\\s*>') as box from pages),
        items as (select page_id, regexp_extract_all(box, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1) as l from boxes),
        texts as (select page_id, unnest(l) as m, generate_subscripts(l, 1) - 1 as item_idx from items)
        select page_id, cast(item_idx as int) as item_idx, trim(replace(replace(replace(replace(
          regexp_replace(m, '<[^>]*>', '', 'g'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')) as text
        from texts""",
    "page_key_from_url": """select page_id, nullif(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1), '') as page_key
        from pages""",
    "html_table_rows": f"with {PAGE_FACTS} {_page_rows()}",
    "html_loose_rows": f"with {PAGE_FACTS} {_page_rows()}",
    "statements_from_pages": f"with {PAGE_FACTS} select {_FACT_COLUMNS} from facts where {YEAR} <> 'TTM'",
    "statements_and_rejects": f"""with {PAGE_FACTS}
        select {COMPANY}, {YEAR}, Sales_plus, case when n_periods % 2 = 1 then null else Interest end as Interest,
          cast(null as varchar) as reason from numbered where n_periods > 5 and {YEAR} <> 'TTM'
        union all
        select cast(o_custkey as varchar), null, null, null, case when n_periods <= 3 then 'no_section'
          when n_periods = 4 then 'no_table' when n_periods = 5 then 'empty_table' else 'ragged_row' end
        from numbered where pos = 1 and (n_periods <= 5 or n_periods % 2 = 1)""",
    "html_row_arity": f"""with {PAGE_FACTS} select o_custkey as page_id, 6 as row_idx, cast(any_value(n_periods) + 1 as int) as n_header,
        cast(any_value(n_periods) as int) as n_cells, 'Interest' as label from numbered
        where n_periods > 5 and n_periods % 2 = 1 group by o_custkey""",
    "html_rejects": f"""with {PAGE_FACTS} select 'pages' as source, cast(o_custkey as varchar) as key,
        case when any_value(n_periods) <= 3 then 'no_section' when any_value(n_periods) = 4 then 'no_table'
          else 'empty_table' end as reason, cast(null as varchar) as raw from numbered where n_periods <= 5 group by o_custkey""",
    "transpose_statement": f"""with {PAGE_FACTS} select o_custkey as page_id, pos, {YEAR}, {_names} from numbered""",
    "period_row_id": f"with {PAGE_FACTS} select pos as id, o_custkey as page_id, {YEAR} from numbered",
    "drop_last_periods": f"""with {PAGE_FACTS} select o_custkey as page_id, pos, {YEAR}, Sales_plus,
        Tax_percent / 100 as Tax_percent from numbered where pos <= n_periods - 2""",
    "keyed_update": f"""with {_ORDERS} select c.c_custkey,
        case when u.up is null then c.c_name else u.c_name end as c_name,
        case when u.up is null then c.c_nationkey else u.c_nationkey end as c_nationkey,
        case when u.up is null then c.c_acctbal else u.c_acctbal end as c_acctbal,
        case when u.up is null then c.c_mktsegment else u.c_mktsegment end as c_mktsegment
        from customer c left join (select * from placed where down = 1) u on c.c_custkey = u.c_custkey""",
    "keyed_delete": f"with {_ORDERS} select * from customer where c_custkey not in (select c_custkey from placed)",
    "upsert_ignore": f"""with {_ORDERS}, target as (select {_CUSTOMER} from customer)
        select * from target union all
        select {_CUSTOMER} from placed where up = 1 and c_custkey not in (select c_custkey from target)""",
    "upsert_replace": f"""with {_ORDERS}, target as (select {_CUSTOMER} from customer)
        select * from target where c_custkey not in (select c_custkey from placed) union all
        select {_CUSTOMER} from placed where down = 1""",
    "snapshot_diff": f"""with {_SNAPSHOTS},
        ins as (select 'INSERT' as operation_type, n.* from new n anti join old o on n.{YEAR} = o.{YEAR}),
        del as (select 'DELETE' as operation_type, o.* from old o anti join new n on n.{YEAR} = o.{YEAR}),
        upd as (select 'UPDATE' as operation_type, n.* from new n join old o on n.{YEAR} = o.{YEAR}
          where n is distinct from o)
        select operation_type, {_AUDIT_TAIL}, {_FACT_COLUMNS}
        from (select * from ins union all select * from del union all select * from upd)""",
    "audit_seed": f"""with {FACTS} select true as id_is_new, 'INSERT' as operation_type, {_AUDIT_TAIL}, {_FACT_COLUMNS}
        from facts""",
    "incremental_scan": f"""with {LOG} select audit_id, operation_type, changed_at, changed_by, {_FACT_COLUMNS}
        from log where changed_at > timestamp '2024-01-15 00:00:00'""",
    "high_water_mark": f"""with {LOG} select changed_at, audit_id from log where changed_at is not null
        order by changed_at desc, audit_id desc limit 1""",
    "read_high_water": """select event_id, case cast(json_extract_string(props, '$.k') as int) % 5
        when 3 then ts when 4 then ts - interval 330 minute end as mark from events""",
    "message_encode": f"""with {LOG} select cast(audit_id as varchar) as key, operation_type,
        strftime(changed_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') as changed_at, {_FACT_COLUMNS} from log""",
    "message_decode": f"with {LOG} select audit_id, operation_type, changed_at, {YEAR}, {_names} from log",
    "cdc_rejects": f"""with {LOG}, judged as (select audit_id, case
          when k = 0 then 'malformed_json'
          when k in (6, 7) then 'malformed_field'
          when k = 1 then 'unknown_operation' when k = 8 then 'null_audit_id'
          when k = 2 then 'null_key' when k = 3 then 'reserved_key'
          when k = 4 and operation_type <> 'DELETE' then 'zero_sales'
          when k = 5 and operation_type <> 'DELETE' then 'null_metric' end as reason, k from log)
        select 'messages' as source, case when k = 8 then 'x' else '' end || audit_id as key, reason from judged where reason is not null""",
    "cdc_apply_keyed": f"{KEYED} select {YEAR}, {_names} from applied",
    "cdc_apply_bag": f"""with {LOG.replace("log as", "plain as", 1)},
        log as (select audit_id, operation_type, changed_at, {YEAR}, {COMPANY}, {_DERIVED_METRICS}, {_DERIVE} from plain),
        {_target(True).replace("target as", "held_plain as", 1)},
        target as (select {YEAR}, {COMPANY}, {_DERIVED_METRICS}, {_DERIVE} from held_plain),
        {_replay([YEAR, COMPANY], _SINK, True)} select * from applied""",
    "cdc_stream_apply_companies": f"""with {LOG.replace("log as", "plain as", 1)},
        log as (select audit_id, operation_type, changed_at, {YEAR}, {COMPANY}, {_DERIVED_METRICS}, {_DERIVE} from plain
          where cast({YEAR} as bigint) % 10 <> 3),
        {_target(True).replace("target as", "held_plain as", 1)},
        target as (select {YEAR}, {COMPANY}, {_DERIVED_METRICS}, {_DERIVE} from held_plain),
        {_replay([YEAR, COMPANY], _SINK, True)} select * from applied""",
    "pages_to_sink": f"""with {PAGE_FACTS} select {YEAR}, {_DERIVED_METRICS}, {COMPANY}, {_DERIVE} from facts
        where {YEAR} <> 'TTM' and Sales_plus <> 0""",
    "profile_conversion": f"""with {CELLS} select l_orderkey, l_linenumber, cast(q as double) as digits,
        cast(q as double) / 100 as percent, p from cells""",
    "publish_increment": f"""with {LOG} select audit_id, operation_type, changed_at, {_FACT_COLUMNS} from log
        where changed_at is not null""",
    "key_list_filter": f"""with {FACTS} select {_FACT_COLUMNS} from facts
        where cast({COMPANY} as int) between 3 and 399 and (cast({COMPANY} as int) - 3) % 7 = 0""",
    "schema_report": f"""with {FACTS}, bad as (select count(*) filter (cast(OPM_percent as bigint) % 5 = 0) as n from facts),
        have as (select * from (values {", ".join(f"('{c}', 'string instead of double')" for c in METRICS[:-1])},
          ('{METRICS[-1]}', 'missing'), ('total_profit', 'missing'), ('net_profit_margin', 'missing'),
          ('profit_category', 'missing'), ('y', 'extra')) as t("column", difference))
        select "column", difference, case when "column" = 'Interest' then n else 0 end as n_unreadable from have, bad""",
    "conform_rejects": f"""with {FACTS} select {YEAR}, {COMPANY}, 'Interest' as "column",
        cast(Interest as varchar) || ' n/a' as raw from facts where cast(OPM_percent as bigint) % 5 = 0""",
    "audit_ids": f"""with {FACTS} select capture, count(*) as n_rows, count(*) as n_ids, true as above
        from facts, (values (1), (2)) as t(capture) group by capture""",
    "maintained_average": f"""{KEYED} select 'AVERAGE' as {YEAR}, {AVERAGE} from applied""",
    "cdc_stream_publish": f"""with {LOG} select audit_id, operation_type, changed_at, {_FACT_COLUMNS} from log""",
    "cdc_stream_apply": f"""{KEYED} select {YEAR}, {_names} from applied
        union all select 'AVERAGE', {AVERAGE} from applied""",
    "sink_replace": f"with {FACTS} select {_FACT_COLUMNS} from facts",
    "sink_append": f"with {FACTS} select {_FACT_COLUMNS} from facts",
    "company_csv_roundtrip": """select c_name || ', "Ltd." & Co' as "Company Name", c_mktsegment as "Industry",
        'C&' || c_custkey as "Symbol", 'EQ' as "Series",
        'INE' || lpad(cast(c_custkey as varchar), 9, '0') as "ISIN Code" from customer""",
    "statement_flow": f"""{KEYED} select {YEAR}, {_names} from applied
        union all select 'AVERAGE', {AVERAGE} from applied""",
}
_LATER = {
    "html_nested_rows": f"""with {PAGE_FACTS}, plain as ({_page_rows()})
        select page_id, case when row_idx < 6 then row_idx else row_idx + 2 end as row_idx, n_header, cells from plain
        union all select page_id, 6, n_header, 'Notes|n1n2|n1|n2' from plain where row_idx = 1
        union all select page_id, 7, n_header, 'n1|n2' from plain where row_idx = 1""",
    "statements_from_nested": ORACLES["statements_from_pages"],
    "page_metrics": f"""with {PAGE_FACTS}, page as (select o_custkey, count(*) as n from facts group by 1),
        named as (
          {" union all ".join(f"select '{m}' as metric, 'number' as kind, o_custkey, n from page" for m in SCRAPED if m != "Interest")}
          union all select case when o_custkey % 3 = 0 then 'Financing_Cost' else 'Interest' end, 'number', o_custkey, n from page
          union all select 'Rating', 'text', o_custkey, n from page where o_custkey % 5 = 1)
        select metric, kind, count(*) as n_pages, cast(sum(n) as bigint) as n_cells from named group by metric, kind""",
    "stack_statements": f"""with {PAGE_FACTS}
        select o_custkey as page_id, pos, {YEAR}, {", ".join(f"{SCRAPED_TO_METRIC[m]} as {m.replace('%', 'percent')}" for m in SCRAPED if m != "Interest")},
          case when o_custkey % 3 = 0 then 0 else Interest end as Interest,
          case when o_custkey % 3 = 0 then Interest else 0 end as Financing_Cost,
          case when o_custkey % 5 = 1 then 'AAok' else '' end as Rating
        from numbered where {YEAR} <> 'TTM'""",
    "cdc_apply_any_order": ORACLES["cdc_apply_keyed"],
    "cdc_apply_once": ORACLES["cdc_apply_bag"],
    "cdc_repeats": """select count(*) as n_changes, 3 * count(*) filter (event_id % 10 = 0) as n_repeated, 0 as n_late from events""",
    "kept_average": f"""{KEYED} select 'AVERAGE' as {YEAR}, {_exact_average()} from applied
        where {YEAR} not in ('TTM', 'AVERAGE')""",
    "audit_sequence": f"""with {FACTS} select 41 + row_number() over (order by {YEAR}, {COMPANY}) as audit_id,
        'INSERT' as operation_type, {_AUDIT_TAIL}, {_FACT_COLUMNS} from facts""",
    "bag_diff": f"""with {_BAGS},
        surplus as (
          select {YEAR}, sum(greatest(-n, 0)) as gone, sum(greatest(n, 0)) as come
          from (select {YEAR}, status, y, o_orderpriority, sum(s) as n
            from (select *, -1 as s from old union all select *, 1 from new) group by all)
          group by {YEAR}
        )
        select {YEAR}, operation_type, cast(n as bigint) as n from (
          select {YEAR}, 'UPDATE' as operation_type, least(gone, come) as n from surplus
          union all select {YEAR}, 'DELETE', gone - least(gone, come) from surplus
          union all select {YEAR}, 'INSERT', come - least(gone, come) from surplus)
        where n > 0""",
    "bag_replay": f"with {_BAGS} select * from new",
    "bag_to_sink": f"""with {_BAGS} select {YEAR}, cast(y as double) as Interest, status as {COMPANY} from new""",
    "polled_stream_publish": ORACLES["cdc_stream_publish"],
    "capture_stream": f"with {_VERSIONS}",
    "capture_versions": f"with {_VERSIONS}",
}
ORACLES |= _LATER

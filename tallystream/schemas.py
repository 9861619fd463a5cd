"""Declared table layouts.

Every write and decode goes through one of these; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Metric columns of the change messages and the sink tables, in table order.
METRICS = [
    "Sales_plus",
    "Expenses_plus",
    "Operating_Profit",
    "OPM_percent",
    "Other_Income_plus",
    "Interest",
    "Depreciation",
    "Profit_before_tax",
    "Tax_percent",
    "Net_Profit_plus",
    "EPS_in_Rs",
    "Dividend_Payout_percent",
]

# The same metrics as a scraped page spells them after header clean-up.
SCRAPED = [
    "Sales",
    "Expenses",
    "Operating_Profit",
    "OPM_%",
    "Other_Income",
    "Interest",
    "Depreciation",
    "Profit_before_tax",
    "Tax_%",
    "Net_Profit",
    "EPS_in_Rs",
    "Dividend_Payout_%",
]

SCRAPED_TO_METRIC = dict(zip(SCRAPED, METRICS))

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
OPERATIONS = [INSERT, UPDATE, DELETE]

TRAILING_PERIOD = "TTM"
AVERAGE_KEY = "AVERAGE"
LABEL_MARK = "TTL"

YEAR, COMPANY = "Year", "Company_id"


def _struct(*groups) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for group in groups for n, t in group])


_METRIC_FIELDS = [(m, T.DoubleType()) for m in METRICS]
_YEAR = [(YEAR, T.StringType())]
_COMPANY = [(COMPANY, T.StringType())]
_DERIVED = [
    ("total_profit", T.DoubleType()),
    ("net_profit_margin", T.DoubleType()),
    ("profit_category", T.StringType()),
]

DERIVED = [n for n, _ in _DERIVED]

PAGE = _struct([("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType())])

FACT = _struct(_YEAR, _METRIC_FIELDS, _COMPANY)

AUDIT = _struct(
    [
        ("audit_id", T.LongType()),
        ("operation_type", T.StringType()),
        ("changed_at", T.TimestampType()),
        ("changed_by", T.StringType()),
    ],
    _YEAR,
    _METRIC_FIELDS,
    _COMPANY,
)

RECORD = _struct([("key", T.BinaryType()), ("value", T.BinaryType())])

_CHANGE = [("operation_type", T.StringType()), ("changed_at", T.TimestampType())]

MESSAGE_SINGLE = _struct(_CHANGE, _YEAR, _METRIC_FIELDS)
MESSAGE_MULTI = _struct(_CHANGE, _YEAR, _METRIC_FIELDS, _COMPANY, _DERIVED)

SINK_SINGLE = _struct(_YEAR, _METRIC_FIELDS)
SINK_MULTI = _struct(_YEAR, _METRIC_FIELDS, _COMPANY, _DERIVED)

COMPANY_DIM = _struct(
    [(n, T.StringType()) for n in ("Company Name", "Industry", "Symbol", "Series", "ISIN Code")]
)

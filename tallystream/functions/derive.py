"""Derived profit columns of the multi-company sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Columns the derivation cannot do without.
REQUIRED = ["Sales_plus", "Operating_Profit", "Other_Income_plus", "Net_Profit_plus", "EPS_in_Rs"]


def profit_category(net: Column) -> Column:
    """Exactly 1000 is High: it is neither below nor above the lower bound."""
    return (
        F.when(net.isNull(), F.lit(None).cast("string"))
        .when(net < 1000, "Low")
        .when((net > 1000) & (net < 5000), "Medium")
        .otherwise("High")
    )


def net_profit_margin(net: Column, sales: Column) -> Column:
    return F.round(F.try_divide(net, sales) * 100, 2)


def derive_profit(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "EPS_in_Rs": F.round("EPS_in_Rs", 2),
            "total_profit": F.col("Operating_Profit") + F.col("Other_Income_plus"),
            "net_profit_margin": net_profit_margin(F.col("Net_Profit_plus"), F.col("Sales_plus")),
            "profit_category": profit_category(F.col("Net_Profit_plus")),
        }
    )


def underivable(of: Column | None = None) -> Column:
    """Reason why a row's derived columns cannot be computed, or null."""
    pick = (lambda n: of[n]) if of is not None else F.col
    missing = reduce(lambda a, b: a | b, [pick(n).isNull() for n in REQUIRED])
    return F.when(missing, "null_metric").when(pick("Sales_plus") == 0, "zero_sales")

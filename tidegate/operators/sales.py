"""Order arithmetic and conditional pivots over order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """Exact money: both factors are decimals before they are multiplied."""
    return (quantity.cast("decimal(10,0)") * unit_price.cast("decimal(12,2)")).cast("decimal(14,2)")


def order_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with their total taken from the lines; never below zero.

    Orders without lines keep the total they had.
    """
    items = lines.groupBy("order_id").agg(F.sum("line_amount").alias("_items"))
    total = F.col("_items") + F.col("shipping_amount") - F.col("discount_amount")
    return (
        orders.join(items, "order_id", "left")
        .withColumn(
            "order_total",
            F.when(F.col("_items").isNull(), F.col("order_total"))
            .otherwise(F.greatest(F.lit(0), total))
            .cast("decimal(14,2)"),
        )
        .drop("_items")
    )


def conditional_pivot(
    df: DataFrame, group: list[str], place: str, value: str, places: list[int], prefix: str
) -> DataFrame:
    """One column per place, filled where the place column has that number."""
    return df.groupBy(*group).agg(
        *[
            F.max(F.when(F.col(place) == n, F.col(value))).alias(f"{prefix}{n}")
            for n in places
        ]
    )

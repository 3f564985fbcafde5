"""Dimensions: product, customer, seller, calendar.

Each builder takes one snapshot of its inputs. The joins carry no broadcast
hint: a small side is broadcast by Spark's own size check, a large one is
shuffled and its hot partitions are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import flag
from orderloom.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_SELLER

# Fixed values of the calendar.
HORIZON_DAYS = 365 * 50
SUNDAY, SATURDAY = 1, 7


def product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category where a translation exists, else the source name."""
    # Products without category match nothing; keeping them out of the join
    # spares the shuffle one hot NULL group.
    named = products.where(F.col("product_category_name").isNotNull())
    unnamed = products.where(F.col("product_category_name").isNull())
    translated = named.join(
        translation.select("category_name_pt", "category_name_en"),
        F.col("product_category_name") == F.col("category_name_pt"),
        "left",
    )
    rows = translated.unionByName(unnamed, allowMissingColumns=True)
    return DIM_PRODUCT.conform(
        rows.withColumn("product_category_pt", F.col("product_category_name")).withColumn(
            "product_category_en", F.coalesce("category_name_en", "product_category_name")
        )
    )


def customer(customers: DataFrame) -> DataFrame:
    return DIM_CUSTOMER.conform(customers)


def seller(sellers: DataFrame) -> DataFrame:
    return DIM_SELLER.conform(sellers)


def date_bounds(orders: DataFrame) -> DataFrame:
    """First and last day of purchase, one row."""
    day = F.to_date("order_purchase_timestamp")
    return orders.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def date(orders: DataFrame, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """Every day from the first purchase to ``horizon_days`` after the last one."""
    last = F.date_add("last_day", horizon_days)
    days = date_bounds(orders).select(F.explode(F.sequence("first_day", last)).alias("day_date"))
    return DIM_DATE.conform(
        days.select(
            F.col("day_date").cast("string").alias("date_id"),
            F.year("day_date").alias("year"),
            F.quarter("day_date").alias("quarter"),
            F.month("day_date").alias("month"),
            F.dayofmonth("day_date").alias("day"),
            flag(F.dayofweek("day_date").isin(SUNDAY, SATURDAY)).alias("is_weekend"),
        )
    )

"""Quality reports: rows failing each cleaning rule, and repeats of documented keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import columns as c
from orderloom.operators.order_groups import deal
from orderloom.schemas import RAW, Table


def order_rules() -> dict[str, Column]:
    status = F.col("order_status")
    return {
        "order_id missing": F.col("order_id").isNull(),
        "customer_id missing": F.col("customer_id").isNull(),
        "status missing": status.isNull(),
        "status void": status.isin(*c.VOID_STATUSES),
        "purchase time missing": F.col("order_purchase_timestamp").isNull(),
    }


def item_rules() -> dict[str, Column]:
    return {
        "order_id missing": F.col("order_id").isNull(),
        "order_item_id missing": F.col("order_item_id").isNull(),
        "product_id missing": F.col("product_id").isNull(),
        "seller_id missing": F.col("seller_id").isNull(),
        "price missing": F.col("price").isNull(),
        "price negative": F.col("price") < 0,
        "freight missing": F.col("freight_value").isNull(),
        "freight negative": F.col("freight_value") < 0,
    }


def payment_rules() -> dict[str, Column]:
    return {
        "order_id missing": F.col("order_id").isNull(),
        "payment_sequential missing": F.col("payment_sequential").isNull(),
        "payment_sequential below 1": F.col("payment_sequential") < 1,
        "instalments missing": F.col("payment_installments").isNull(),
        "instalments zero": F.col("payment_installments") == 0,
        "value missing": F.col("payment_value").isNull(),
        "value negative": F.col("payment_value") < 0,
    }


def review_rules() -> dict[str, Column]:
    return {
        "order_id missing": F.col("order_id").isNull(),
        "review_id missing": F.col("review_id").isNull(),
        "score missing": F.col("review_score").isNull(),
        "score out of range": ~c.valid_score(),
        "creation time missing": F.col("review_creation_date").isNull(),
    }


RULES = {"orders": order_rules, "items": item_rules, "payments": payment_rules, "reviews": review_rules}

#: Rules whose rows are mended and loaded.
MENDED = ("instalments zero",)


def judged(rows: DataFrame, table_name: str) -> DataFrame:
    """The rows with the rules they break, in one pass; a rule that cannot be decided is not broken."""
    broken = [F.when(condition, F.lit(rule)) for rule, condition in RULES[table_name]().items() if rule not in MENDED]
    return rows.withColumn("broken_rules", F.array_compact(F.array(*broken)))


def split(rows: DataFrame, table_name: str) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and rejected ones with the rules they break: together they are all rows."""
    found = judged(rows, table_name)
    clean = F.size("broken_rules") == 0
    return found.where(clean).drop("broken_rules"), found.where(~clean)


def key_value(table: Table) -> Column:
    """Key columns joined by ``|``, NULL as ``\\N``."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit(r"\N")) for k in table.key]).alias("key_value")


def report(rows: DataFrame, table_name: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule; all rules are counted in a single pass over the rows."""
    counted = rows.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        *[F.count_if(broken).alias(f"rule_{n}") for n, broken in enumerate(rules.values())],
    )
    pairs = [
        F.struct(F.lit(rule).alias("rule"), F.col(f"rule_{n}").alias("failed_rows")) for n, rule in enumerate(rules)
    ]
    return counted.select("checked_rows", F.explode(F.array(*pairs)).alias("found")).select(
        F.lit(table_name).alias("table_name"), "found.rule", "checked_rows", "found.failed_rows"
    )


def orphans(rows: DataFrame, orders: DataFrame, table_name: str) -> DataFrame:
    """Rows whose order is unknown; counted per order first, so a busy order moves as one row."""
    per_order = rows.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows"))
    known = orders.select("order_id").distinct().withColumn("known", F.lit(True))
    return (
        per_order.join(known, "order_id", "left")
        .agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("checked_rows"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n_rows"))), F.lit(0)).alias("failed_rows"),
        )
        .select(
            F.lit(table_name).alias("table_name"), F.lit("order unknown").alias("rule"), "checked_rows", "failed_rows"
        )
    )


def orders_report(orders: DataFrame, items: DataFrame) -> DataFrame:
    return (
        report(orders, "orders", order_rules())
        .unionByName(report(items, "items", item_rules()))
        .unionByName(orphans(items, orders, "items"))
    )


def payments_report(payments: DataFrame, orders: DataFrame) -> DataFrame:
    return report(payments, "payments", payment_rules()).unionByName(orphans(payments, orders, "payments"))


def reviews_report(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    return report(reviews, "reviews", review_rules()).unionByName(orphans(reviews, orders, "reviews"))


def duplicate_keys(rows: DataFrame, table: Table, table_name: str, *more: str) -> DataFrame:
    """Key values that occur more than once, key columns joined by ``|``, NULL as ``\\N``; ``more``: key columns to keep.

    Keys are mostly distinct, so combining them in the tasks that read them would only hold them once more. They are
    dealt as they come, and a task holds the keys of its share; a key that repeats is counted as it streams by.
    """
    return (
        deal(rows.select(*table.key), *table.key)
        .groupBy(*table.key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
        .select(
            *more,
            F.lit(table_name).alias("table_name"),
            key_value(table),
            "n_rows",
        )
    )


def rules_report(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    return (
        orders_report(orders, items)
        .unionByName(payments_report(payments, orders))
        .unionByName(reviews_report(reviews, orders))
    )


def all_duplicate_keys(raw: Mapping[str, DataFrame], *more: str) -> DataFrame:
    """Repeats in every raw table that declares a key."""
    found = [duplicate_keys(rows, RAW[name], name, *more) for name, rows in raw.items() if RAW[name].key]
    return reduce(DataFrame.unionByName, found)


def late_rows(changes: DataFrame, table_name: str) -> DataFrame:
    """Rows that came after their order was loaded, from the orders a load found changed."""
    n, before = F.col(f"n_{table_name}"), F.col(f"n_{table_name}_before")
    loaded = changes.where((F.col("change") == "changed") & F.col("day_before").isNotNull())
    return loaded.agg(F.coalesce(F.sum(n), F.lit(0)).alias("checked_rows"), F.coalesce(F.sum(F.greatest(n - before, F.lit(0))), F.lit(0)).alias("failed_rows")).select(
        F.lit(table_name).alias("table_name"), F.lit("not loaded with its order").alias("rule"), "checked_rows", "failed_rows"
    )

"""Declared tables: columns with types and comments, and their documented keys."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TIME = T.TimestampNTZType()
_PRICE = T.DecimalType(10, 2)
_LINE_TOTAL = T.DecimalType(11, 2)
_MONEY = T.DecimalType(28, 2)
_MEAN = T.DecimalType(10, 2)
_RATE = T.DecimalType(10, 4)

DT = T.StructField("dt", _STRING, True, {"comment": "data date, yyyy-MM-dd"})
MONTH = T.StructField("month", _STRING, True, {"comment": "month of date_id, yyyy-MM"})


@dataclass(frozen=True)
class Table:
    name: str
    comment: str
    key: tuple[str, ...]
    columns: tuple[tuple[str, T.DataType, str], ...]
    dated: bool = True
    #: Below ``dt`` the rows lie by the month of their ``date_id``, so that a few days are read without the rest.
    by_month: bool = False
    #: Each ``dt`` is dealt and sorted by this column, so that joins and groupings by it need no shuffle.
    bucketed_by: str | None = None

    @property
    def names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        """Columns without the partition column."""
        return T.StructType(
            [T.StructField(name, kind, True, {"comment": note}) for name, kind, note in self.columns]
        )

    @property
    def stored(self) -> T.StructType:
        """Columns as read back from storage; ``dt`` is pinned to text."""
        return T.StructType([*self.schema.fields, DT]) if self.dated else self.schema

    def named(self, name: str) -> Table:
        """Another table of the same shape."""
        return replace(self, name=name)

    def conform(self, rows: DataFrame) -> DataFrame:
        """Pick by name, order and type as declared; a value that does not fit raises."""
        return rows.to(self.schema)


# --- raw tables -------------------------------------------------------------

ORDERS = Table("ods_orders_df", "orders, daily full snapshot", ("order_id",), (
    ("order_id", _STRING, "order"),
    ("customer_id", _STRING, "customer as known to the order"),
    ("order_status", _STRING, "state of the order"),
    ("order_purchase_timestamp", _TIME, "purchase"),
    ("order_approved_at", _TIME, "payment approved"),
    ("order_delivered_carrier_date", _TIME, "handed to the carrier"),
    ("order_delivered_customer_date", _TIME, "received by the customer"),
    ("order_estimated_delivery_date", _TIME, "promised delivery"),
))

CUSTOMERS = Table("ods_customers_df", "customers, daily full snapshot", ("customer_id",), (
    ("customer_id", _STRING, "customer as known to the order"),
    ("customer_unique_id", _STRING, "person behind one or more customer ids"),
    ("customer_zip_code_prefix", _STRING, "zip prefix, leading zeros kept"),
    ("customer_city", _STRING, "city"),
    ("customer_state", _STRING, "state"),
))

PAYMENTS = Table("ods_payments_df", "payments, daily full snapshot", ("order_id", "payment_sequential"), (
    ("order_id", _STRING, "order"),
    ("payment_sequential", _INT, "running number within the order"),
    ("payment_type", _STRING, "means of payment"),
    ("payment_installments", _INT, "number of instalments"),
    ("payment_value", _PRICE, "amount paid"),
))

REVIEWS = Table("ods_reviews_df", "reviews, daily full snapshot", ("order_id", "review_id"), (
    ("review_id", _STRING, "review"),
    ("order_id", _STRING, "order"),
    ("review_score", _INT, "score, 1 to 5"),
    ("review_comment_title", _STRING, "title"),
    ("review_comment_message", _STRING, "text"),
    ("review_creation_date", _TIME, "review asked for"),
    ("review_answer_timestamp", _TIME, "shop replied"),
))

ITEMS = Table("ods_items_df", "order items, daily full snapshot", ("order_id", "order_item_id"), (
    ("order_id", _STRING, "order"),
    ("order_item_id", _INT, "running number within the order"),
    ("product_id", _STRING, "product"),
    ("seller_id", _STRING, "seller"),
    ("shipping_limit_date", _TIME, "latest shipping promised by the seller"),
    ("price", _PRICE, "price of the item"),
    ("freight_value", _PRICE, "freight of the item"),
))

SELLERS = Table("ods_sellers_df", "sellers, daily full snapshot", ("seller_id",), (
    ("seller_id", _STRING, "seller"),
    ("seller_zip_code_prefix", _STRING, "zip prefix, leading zeros kept"),
    ("seller_city", _STRING, "city"),
    ("seller_state", _STRING, "state"),
))

GEOLOCATION = Table("ods_geolocation_df", "zip prefix positions, daily full snapshot", (), (
    ("geolocation_zip_code_prefix", _STRING, "zip prefix, leading zeros kept"),
    ("geolocation_lat", _DOUBLE, "latitude"),
    ("geolocation_lng", _DOUBLE, "longitude"),
    ("geolocation_city", _STRING, "city"),
    ("geolocation_state", _STRING, "state"),
))

# "lenght" is how the source spells it.
PRODUCTS = Table("ods_products_df", "products, daily full snapshot", ("product_id",), (
    ("product_id", _STRING, "product"),
    ("product_category_name", _STRING, "category, source language"),
    ("product_name_lenght", _INT, "characters in the name"),
    ("product_description_lenght", _INT, "characters in the description"),
    ("product_photos_qty", _INT, "number of photos"),
    ("product_weight_g", _INT, "weight, gram"),
    ("product_length_cm", _INT, "length, centimetre"),
    ("product_height_cm", _INT, "height, centimetre"),
    ("product_width_cm", _INT, "width, centimetre"),
))

TRANSLATION = Table("ods_category_translation_df", "category names, daily full snapshot", ("category_name_pt",), (
    ("category_name_pt", _STRING, "category, source language"),
    ("category_name_en", _STRING, "category, English"),
))

RAW = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "payments": PAYMENTS,
    "reviews": REVIEWS,
    "items": ITEMS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
    "products": PRODUCTS,
    "translation": TRANSLATION,
}

# --- dimensions -------------------------------------------------------------

DIM_PRODUCT = Table("dim_product_1d", "products, daily full", ("product_id",), (
    ("product_id", _STRING, "product"),
    ("product_category_pt", _STRING, "category, source language"),
    ("product_category_en", _STRING, "category, English where known"),
    ("product_weight_g", _INT, "weight, gram"),
    ("product_length_cm", _INT, "length, centimetre"),
    ("product_height_cm", _INT, "height, centimetre"),
    ("product_width_cm", _INT, "width, centimetre"),
))

DIM_CUSTOMER = Table("dim_customer_1d", "customers, daily full", ("customer_id",), (
    ("customer_id", _STRING, "customer as known to the order"),
    ("customer_unique_id", _STRING, "person behind one or more customer ids"),
    ("customer_city", _STRING, "city"),
    ("customer_state", _STRING, "state"),
))

DIM_SELLER = Table("dim_seller_1d", "sellers, daily full", ("seller_id",), (
    ("seller_id", _STRING, "seller"),
    ("seller_city", _STRING, "city"),
    ("seller_state", _STRING, "state"),
))

DIM_DATE = Table("dim_date", "calendar without gaps", ("date_id",), (
    ("date_id", _STRING, "day, yyyy-MM-dd"),
    ("year", _INT, "year"),
    ("quarter", _INT, "quarter"),
    ("month", _INT, "month"),
    ("day", _INT, "day of the month"),
    ("is_weekend", _INT, "1 on Saturday and Sunday"),
), dated=False)

# --- facts ------------------------------------------------------------------

FACT_ORDER = Table("fact_order_di", "order fulfilment, one row per order item", ("order_id", "order_item_id"), (
    ("order_id", _STRING, "order"),
    ("order_item_id", _INT, "running number within the order"),
    ("customer_id", _STRING, "customer"),
    ("seller_id", _STRING, "seller"),
    ("product_id", _STRING, "product"),
    ("date_id", _STRING, "day of purchase"),
    ("order_status", _STRING, "state of the order"),
    ("order_purchase_timestamp", _TIME, "purchase"),
    ("order_delivered_carrier_date", _TIME, "handed to the carrier"),
    ("order_delivered_customer_date", _TIME, "received by the customer"),
    ("order_estimated_delivery_date", _TIME, "promised delivery"),
    ("order_approved_at", _TIME, "payment approved"),
    ("shipping_limit_date", _TIME, "latest shipping promised by the seller"),
    ("price", _PRICE, "price of the item"),
    ("freight_value", _PRICE, "freight of the item"),
    ("item_count", _LONG, "valid items of the order"),
    ("total_amount", _LINE_TOTAL, "price and freight of the item"),
    ("order_total_amount", _MONEY, "price and freight of the order's valid items"),
    ("deliver_duration", _INT, "days from carrier to customer"),
    ("total_duration", _INT, "days from purchase to customer"),
), by_month=True)

FACT_PAYMENT = Table("fact_payment_di", "payments, one row per payment", ("order_id", "payment_sequential"), (
    ("order_id", _STRING, "order"),
    ("payment_sequential", _INT, "running number within the order"),
    ("customer_id", _STRING, "customer"),
    ("date_id", _STRING, "day of purchase"),
    ("payment_type", _STRING, "means of payment"),
    ("payment_installments", _INT, "number of instalments, 0 repaired to 1"),
    ("payment_value", _PRICE, "amount paid"),
    ("payment_attempts", _INT, "highest running number within the order"),
    ("is_installment", _INT, "1 when paid in more than one instalment"),
), by_month=True)

FACT_REVIEW = Table("fact_review_di", "reviews, one row per review", ("order_id", "review_id"), (
    ("order_id", _STRING, "order"),
    ("review_id", _STRING, "review"),
    ("customer_id", _STRING, "customer"),
    ("date_id", _STRING, "day the review was asked for"),
    ("review_comment_message", _STRING, "text"),
    ("order_delivered_customer_date", _TIME, "received by the customer"),
    ("review_creation_date", _TIME, "review asked for"),
    ("review_answer_timestamp", _TIME, "shop replied"),
    ("review_score", _INT, "score, 1 to 5"),
    ("score_bucket", _INT, "1 bad, 2 neutral, 3 good"),
    ("is_good_review", _INT, "1 for a score of 4 or 5"),
    ("days_to_review", _INT, "days from delivery to review"),
    ("is_reply", _INT, "1 when the shop replied"),
    ("hours_to_reply", _INT, "hours from review to reply"),
    ("comment_count", _INT, "characters in the text"),
    ("has_comment", _INT, "1 when there is text"),
), by_month=True)

# --- summaries --------------------------------------------------------------


def order_metrics(prefix: str, total: str) -> tuple[tuple[str, T.DataType, str], ...]:
    """The ten order metrics; totals and means carry their own name stems."""
    return (
        (f"{total}_gmv", _MONEY, "sum of item totals"),
        (f"{total}_order_count", _LONG, "distinct orders"),
        (f"{total}_customer_count", _LONG, "distinct customers"),
        (f"{prefix}avg_order_amount", _MONEY, "item totals per order"),
        (f"{prefix}avg_customer_amount", _MONEY, "item totals per customer"),
        (f"{prefix}avg_item_count", _MEAN, "items per order"),
        (f"{prefix}new_customer_rate", _RATE, "customers on their first day"),
        (f"{prefix}avg_deliver_duration", _MEAN, "days from carrier to customer, delivered orders"),
        (f"{prefix}avg_total_duration", _MEAN, "days from purchase to customer, delivered orders"),
        (f"{prefix}overtime_rate", _RATE, "orders received after the promised day"),
    )


SUM_ORDER_BY_DATE = Table(
    "sum_order_by_date_1d", "orders by day", ("date_id",),
    (("date_id", _STRING, "day of purchase"), *order_metrics("", "daily")),
)

SUM_ORDER_BY_CATEGORY = Table(
    "sum_order_by_category_1d", "orders by product category", ("cate_name",),
    (("cate_name", _STRING, "category, English where known"), *order_metrics("cate_", "cate")),
)

SUM_ORDER_BY_CUSTOMER_REGION = Table(
    "sum_order_by_customer_region_1d", "orders by home of the customer", ("customer_state", "customer_city"),
    (("customer_state", _STRING, "state"), ("customer_city", _STRING, "city"),
     *(column for column in order_metrics("region_", "region") if column[0] != "region_new_customer_rate")),
)

SUM_ORDER_BY_SELLER_REGION = Table(
    "sum_order_by_seller_region_1d", "orders by home of the seller", ("seller_state", "seller_city"),
    (("seller_state", _STRING, "state"), ("seller_city", _STRING, "city"), *order_metrics("region_", "region")),
)

SUM_PAYMENT_BY_DATE = Table("sum_payment_by_date_1d", "payments by day", ("date_id",), (
    ("date_id", _STRING, "day of purchase"),
    ("daily_payment_value", _MONEY, "amount paid"),
    ("daily_payment_count", _LONG, "payments"),
    ("installment_rate", _RATE, "payments in instalments"),
    ("installment_gmv_rate", _RATE, "amount paid in instalments"),
    ("avg_installments", _MEAN, "instalments per payment in instalments"),
    ("avg_payment_attempts", _MEAN, "highest running number per order"),
))

SUM_REVIEW_BY_DATE = Table("sum_review_by_date_1d", "reviews by day", ("date_id",), (
    ("date_id", _STRING, "day the review was asked for"),
    ("daily_review_count", _LONG, "reviews"),
    ("avg_review_score", _MEAN, "score"),
    ("good_review_rate", _RATE, "reviews with a score of 4 or 5"),
    ("reply_rate", _RATE, "reviews the shop replied to"),
    ("avg_hours_to_reply", _MEAN, "hours from review to reply"),
    ("has_comment_rate", _RATE, "reviews with text"),
))

SUM_STATUS_BY_DATE = Table("sum_order_status_by_date_1d", "order states by day", ("date_id",), (
    ("date_id", _STRING, "day of purchase"),
    ("placed_order_count", _LONG, "orders of any state"),
    ("canceled_order_count", _LONG, "canceled orders"),
    ("unavailable_order_count", _LONG, "orders out of stock"),
    ("unknown_order_count", _LONG, "orders without a state"),
    ("canceled_rate", _RATE, "canceled orders"),
    ("unavailable_rate", _RATE, "orders out of stock"),
))

FIRST_PURCHASE = Table("first_purchase_1d", "first day of the customers whose orders a load found changed", ("customer_id",), (
    ("customer_id", _STRING, "customer as known to the order"),
    ("first_day", T.DateType(), "first day of purchase; null where no order is left"),
), bucketed_by="customer_id")

# --- what loads remember ----------------------------------------------------

_ORDER_STATE = (
    ("customer_id", _STRING, "customer"),
    ("day", T.DateType(), "day of purchase, within the days loaded"),
    ("first_review", T.DateType(), "first day a review was asked for, within the days loaded"),
    ("last_review", T.DateType(), "last such day"),
    ("in_fact", T.BooleanType(), "the order fact has rows of it"),
)

ORDER_STATE = Table("order_state_1d", "orders that a load found new, changed or gone, with all rows that belong to them", ("order_id",), (
    ("order_id", _STRING, "order"),
    *_ORDER_STATE,
    ("n_orders", _LONG, "rows of the order itself, 0 once it is gone or where it is unknown"),
    ("n_items", _LONG, "item rows"),
    ("n_payments", _LONG, "payment rows"),
    ("n_reviews", _LONG, "review rows, within the days loaded"),
    ("print", _LONG, "hash of all these rows"),
    ("change", _STRING, "inserted, changed, removed, or kept by a full load"),
    *((f"{name}_before", kind, f"{note}, as the load before had it") for name, kind, note in _ORDER_STATE),
    ("n_items_before", _LONG, "item rows, as the load before had it"),
    ("n_payments_before", _LONG, "payment rows, as the load before had it"),
), bucketed_by="order_id")

#: The same before the customers are known.
ORDER_CHANGES = replace(ORDER_STATE, name="order_changes_1d", bucketed_by=None)

TOUCHED_DAYS = Table("touched_days_1d", "days whose summaries a load computed anew", ("source", "date_id"), (
    ("source", _STRING, "orders or reviews"),
    ("date_id", _STRING, "day"),
    ("had_rows", T.BooleanType(), "an earlier load may have a row of the day"),
))

LOADS = Table("load_log_1d", "loads", ("dt",), (
    ("start", _STRING, "first time loaded"),
    ("end", _STRING, "first time not loaded"),
    ("whole", T.BooleanType(), "a full load"),
))

# --- boards and quality -----------------------------------------------------

_BY_DATE = {
    column[0]: column
    for table in (SUM_ORDER_BY_DATE, SUM_STATUS_BY_DATE, SUM_PAYMENT_BY_DATE, SUM_REVIEW_BY_DATE)
    for column in table.columns
}


def _board(role: str, comment: str, *names: str) -> Table:
    return Table(f"board_{role}_1d", comment, ("date_id",), tuple(_BY_DATE[name] for name in ("date_id", *names)))


BOARD_OPERATIONS = _board(
    "operations", "sales and customers by day", "daily_gmv", "daily_order_count", "daily_customer_count",
    "avg_order_amount", "avg_customer_amount", "avg_item_count", "new_customer_rate", "placed_order_count",
    "canceled_rate", "unavailable_rate",
)
BOARD_LOGISTICS = _board(
    "logistics", "delivery by day", "daily_order_count", "avg_deliver_duration", "avg_total_duration", "overtime_rate",
)
BOARD_PAYMENT = _board(
    "payment", "payments by day", "daily_payment_value", "daily_payment_count", "installment_rate",
    "installment_gmv_rate", "avg_installments", "avg_payment_attempts",
)
BOARD_SERVICE = _board(
    "service", "reviews by day", "daily_review_count", "avg_review_score", "good_review_rate", "reply_rate",
    "avg_hours_to_reply", "has_comment_rate",
)
BOARDS = (BOARD_OPERATIONS, BOARD_LOGISTICS, BOARD_PAYMENT, BOARD_SERVICE)

QUALITY_RULES = Table("quality_rules_1d", "rows that fail a cleaning rule", ("table_name", "rule"), (
    ("table_name", _STRING, "raw table"),
    ("rule", _STRING, "rule"),
    ("checked_rows", _LONG, "rows checked"),
    ("failed_rows", _LONG, "rows that fail"),
))

QUALITY_DUPLICATES = Table("quality_duplicate_keys_1d", "repeated keys", ("table_name", "key_value"), (
    ("table_name", _STRING, "raw table"),
    ("key_value", _STRING, "key columns joined by |, null as \\N"),
    ("n_rows", _LONG, "rows with the key"),
))

DUPLICATE_STATE = Table("duplicate_state_1d", "repeated keys of the orders that a load found changed", ("table_name", "key_value"), (
    ("order_id", _STRING, "order"),
    *QUALITY_DUPLICATES.columns,
))

#: Rows no fact takes, with the rules they break.
REJECTED = {
    name: Table(f"rejected_{name}_1d", f"{name} that break a cleaning rule", RAW[name].key,
                (*RAW[name].columns, ("broken_rules", T.ArrayType(_STRING), "rules the row breaks")))
    for name in ("orders", "items", "payments", "reviews")
}

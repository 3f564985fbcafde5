"""Checking SQL for the registered queries, run by DuckDB on the same test tables.

It is written the plain way (row windows, distinct counts, joins of finished
groupings) so that it does not share the shape of the Spark builders. Rounding
is done on whole numbers: DuckDB rounds doubles from their binary value, Spark
from the shortest decimal text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from orderloom import schemas as s
from orderloom.params import LoadWindow
from orderloom.plans.queries import DAY, EARLIER_DT, FULL, LATER_DT, MONTH, SNAPSHOTS
from orderloom.schemas import Table
from orderloom.sources.bindings import TRANSLATION_COLUMNS, UNTRANSLATED, raw_sql, state_sql

ORACLES: dict[str, str] = {}

# --- building blocks --------------------------------------------------------


def _with(parts: dict[str, str], body: str) -> str:
    ctes = ",\n".join(f"{name} as (\n{sql}\n)" for name, sql in parts.items())
    return f"with {ctes}\n{body}" if parts else body


def _raw(*names: str) -> dict[str, str]:
    return {f"raw_{name}": raw_sql(name) for name in names}


def _typed(table: Table, source: str, extra: str = "") -> str:
    """Columns of a table in comparable types: decimals as doubles, times as text."""
    kinds = {T.StringType: "varchar", T.IntegerType: "integer", T.LongType: "bigint", T.TimestampNTZType: "varchar"}
    columns = [f"cast({name} as {kinds.get(type(kind), 'double')}) as {name}" for name, kind, _ in table.columns]
    return f"select {', '.join(columns)}{extra} from {source}"


def _inside(time: str, window: LoadWindow) -> str:
    return f"{time} >= timestamp '{window.start}' and {time} < timestamp '{window.end}'"


def _rate(part: str, whole: str) -> str:
    return f"((({part}) * 20000 + ({whole})) // nullif(2 * ({whole}), 0)) / 10000.0"


def _mean(total: str, count: str) -> str:
    return f"((({total}) * 200 + ({count})) // nullif(2 * ({count}), 0)) / 100.0"


def _mean_money(total_cents: str, count: str) -> str:
    return f"((({total_cents}) * 2 + ({count})) // nullif(2 * ({count}), 0)) / 100.0"


def _days(start: str, end: str) -> str:
    return f"date_diff('day', cast({start} as date), cast({end} as date))"


def _day(time: str) -> str:
    return f"cast(cast({time} as date) as varchar)"


def _cents(amount: str) -> str:
    return f"cast({amount} * 100 as bigint)"


SOUND_STATUS = "order_status not in ('canceled', 'unavailable')"
SOUND_MEASURES = "price >= 0 and freight_value >= 0"
LATE = "coalesce(cast(order_delivered_customer_date > order_estimated_delivery_date as integer), 0)"


def _fact_order(window: LoadWindow) -> str:
    bought = _inside("order_purchase_timestamp", window)
    return f"""
    with sound as (
        select *, price + freight_value as total_amount
        from raw_items join raw_orders using (order_id)
        where {SOUND_STATUS} and {SOUND_MEASURES} and {bought}
          and order_item_id is not null and product_id is not null and seller_id is not null
    ), sums as (
        select order_id, count(order_item_id) as item_count, sum(total_amount) as order_total_amount
        from sound group by order_id
    )
    select sound.*, item_count, order_total_amount,
        {_day('order_purchase_timestamp')} as date_id,
        {_days('order_delivered_carrier_date', 'order_delivered_customer_date')} as deliver_duration,
        {_days('order_purchase_timestamp', 'order_delivered_customer_date')} as total_duration
    from sound join sums using (order_id)"""


def _fact_payment(window: LoadWindow) -> str:
    bought = _inside("order_purchase_timestamp", window)
    return f"""
    with sound as (
        select p.*, customer_id, {_day('order_purchase_timestamp')} as date_id
        from raw_payments p join raw_orders o on o.order_id = p.order_id
        where payment_sequential >= 1 and payment_value >= 0 and payment_installments is not null
          and customer_id is not null and {bought}
    ), sums as (
        select order_id, max(payment_sequential) as payment_attempts from sound group by order_id
    )
    select sound.* replace (greatest(payment_installments, 1) as payment_installments),
        payment_attempts, cast(payment_installments > 1 as integer) as is_installment
    from sound join sums using (order_id)"""


def _fact_review(window: LoadWindow) -> str:
    created = _inside("review_creation_date", window)
    return f"""
    select r.*, customer_id, order_delivered_customer_date,
        {_day('review_creation_date')} as date_id,
        case review_score when 1 then 1 when 2 then 1 when 3 then 2 else 3 end as score_bucket,
        cast(review_score in (4, 5) as integer) as is_good_review,
        {_days('order_delivered_customer_date', 'review_creation_date')} as days_to_review,
        cast(review_answer_timestamp is not null as integer) as is_reply,
        round(datesub('minute', review_creation_date, review_answer_timestamp) / 60.0) as hours_to_reply,
        length(review_comment_message) as comment_count,
        cast(coalesce(review_comment_message, '') <> '' as integer) as has_comment
    from raw_reviews r join raw_orders o on o.order_id = r.order_id
    where review_score in (1, 2, 3, 4, 5) and customer_id is not null and {created}"""


DIM_PRODUCT = """
    select product_id, product_category_name as product_category_pt,
        coalesce(category_name_en, product_category_name) as product_category_en,
        product_weight_g, product_length_cm, product_height_cm, product_width_cm
    from raw_products left join raw_translation on category_name_pt = product_category_name"""

CALENDAR = f"""
    select cast(cast(d as date) as varchar) as date_id, cast(year(d) as integer) as year,
        cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month,
        cast(day(d) as integer) as day, cast(dayofweek(d) in (0, 6) as integer) as is_weekend
    from (
        select unnest(generate_series(lo, hi + {365 * 50}, interval 1 day)) as d
        from (
            select min(cast(order_purchase_timestamp as date)) as lo, max(cast(order_purchase_timestamp as date)) as hi
            from raw_orders
        )
    )"""


def _order_summary(
    keys: list[str], prefix: str, total: str, source: str, blank_unnamed: bool = False, only: str = "true"
) -> str:
    """The ten order metrics from item rows: row-level grouping joined to order-level means.

    First days are taken before ``only`` narrows the rows.
    """
    by = ", ".join(keys)
    same = " and ".join(f"g.{key} is not distinct from m.{key}" for key in keys)
    named = " and ".join(f"g.{key} is not null" for key in keys) if blank_unnamed else "true"
    out = ", ".join(f"g.{key}" for key in keys)
    return f"""
    with known as (
        select *, {LATE} as late, {_cents('total_amount')} as amount,
            date_id = min(date_id) over (partition by customer_id) as first_day
        from {source}
    ), flagged as (
        select * from known where {only}
    ), groups as (
        select {by}, sum(amount) as amount, count(*) as item_rows,
            count(distinct order_id) as orders, count(distinct customer_id) as customers,
            count(distinct customer_id) filter (where first_day) as new_customers
        from flagged group by {by}
    ), means as (
        select {by}, sum(d) as d_sum, count(d) as d_n, sum(t) as t_sum, count(t) as t_n,
            sum(late) as late_sum, count(*) as n
        from (
            select {by}, order_id, max(deliver_duration) as d, max(total_duration) as t, max(late) as late
            from flagged group by {by}, order_id
        ) group by {by}
    )
    select {out}, amount / 100.0 as {total}_gmv, orders as {total}_order_count, customers as {total}_customer_count,
        {_mean_money('amount', 'orders')} as {prefix}avg_order_amount,
        {_mean_money('amount', 'customers')} as {prefix}avg_customer_amount,
        {_mean('item_rows', 'orders')} as {prefix}avg_item_count,
        {_rate('new_customers', 'customers')} as {prefix}new_customer_rate,
        case when {named} then {_mean('d_sum', 'd_n')} end as {prefix}avg_deliver_duration,
        case when {named} then {_mean('t_sum', 't_n')} end as {prefix}avg_total_duration,
        case when {named} then {_rate('late_sum', 'n')} end as {prefix}overtime_rate
    from groups g join means m on {same}"""


def _payment_summary(rows: str) -> str:
    return f"""
    with kept as ({rows}), groups as (
        select date_id, sum({_cents('payment_value')}) as amount, count(*) as n, sum(is_installment) as split_n,
            coalesce(sum({_cents('payment_value')}) filter (where is_installment = 1), 0) as split_amount,
            sum(payment_installments) filter (where is_installment = 1) as parts
        from kept group by date_id
    ), tries as (
        select date_id, sum(a) as a_sum, count(*) as a_n
        from (select date_id, order_id, max(payment_attempts) as a from kept group by date_id, order_id)
        group by date_id
    )
    select date_id, amount / 100.0 as daily_payment_value, n as daily_payment_count,
        {_rate('split_n', 'n')} as installment_rate, {_rate('split_amount', 'amount')} as installment_gmv_rate,
        {_mean('parts', 'split_n')} as avg_installments, {_mean('a_sum', 'a_n')} as avg_payment_attempts
    from groups join tries using (date_id)"""


def _review_summary(rows: str) -> str:
    return f"""
    select date_id, count(*) as daily_review_count,
        {_mean('sum(review_score)', 'count(*)')} as avg_review_score,
        {_rate('sum(is_good_review)', 'count(*)')} as good_review_rate,
        {_rate('sum(is_reply)', 'count(*)')} as reply_rate,
        {_mean('sum(cast(hours_to_reply as bigint))', 'count(hours_to_reply)')} as avg_hours_to_reply,
        {_rate('sum(has_comment)', 'count(*)')} as has_comment_rate
    from ({rows}) group by date_id"""


KEPT_ORDERS = "where order_id in (select order_id from fact_order)"
EACH_ITEM = "join (select order_id as item_order from fact_order) on item_order = order_id"

STATUS_SUMMARY = f"""
    select {_day('order_purchase_timestamp')} as date_id, count(*) as placed_order_count,
        count(*) filter (where order_status = 'canceled') as canceled_order_count,
        count(*) filter (where order_status = 'unavailable') as unavailable_order_count,
        count(*) filter (where order_status is null) as unknown_order_count,
        {_rate("count(*) filter (where order_status = 'canceled')", 'count(*)')} as canceled_rate,
        {_rate("count(*) filter (where order_status = 'unavailable')", 'count(*)')} as unavailable_rate
    from raw_orders where {_inside('order_purchase_timestamp', FULL)} group by 1"""

_FACT = {**_raw("orders", "items"), "fact_order": _fact_order(FULL)}
_PAYMENT = {**_raw("payments"), **_FACT, "fact_payment": _fact_payment(FULL)}
_REVIEW = {**_raw("reviews"), **_FACT, "fact_review": _fact_review(FULL)}


def _dated(dt: str) -> str:
    return f", '{dt}' as dt"


# --- raw snapshots and increments -------------------------------------------

for _name in ("orders", "customers", "payments", "reviews", "items", "sellers", "geolocation", "products"):
    ORACLES[f"ods_{_name}"] = _with(_raw(_name), _typed(s.RAW[_name], f"raw_{_name}", _dated(FULL.dt)))

_COL_1, _COL_2 = TRANSLATION_COLUMNS.values()
ORACLES["ods_category_translation"] = (
    f"select {_COL_1} as category_name_pt, {_COL_2} as category_name_en, '{FULL.dt}' as dt"
    f" from part where p_brand <> '{UNTRANSLATED}' group by p_brand"
)

_BOUGHT = f"raw_orders where {_inside('order_purchase_timestamp', MONTH)}"
ORACLES["ods_orders_increment"] = _with(_raw("orders"), _typed(s.ORDERS, _BOUGHT, _dated(MONTH.dt)))
for _name in ("items", "payments"):
    ORACLES[f"ods_{_name}_increment"] = _with(
        _raw("orders", _name),
        _typed(s.RAW[_name], f"raw_{_name} where order_id in (select order_id from {_BOUGHT})", _dated(MONTH.dt)),
    )
ORACLES["ods_reviews_increment"] = _with(
    _raw("reviews"),
    _typed(s.REVIEWS, f"raw_reviews where {_inside('review_creation_date', MONTH)}", _dated(MONTH.dt)),
)

# --- dimensions -------------------------------------------------------------

ORACLES["dim_product"] = _with(_raw("products", "translation"), _typed(s.DIM_PRODUCT, f"({DIM_PRODUCT})"))
ORACLES["dim_customer"] = _with(_raw("customers"), _typed(s.DIM_CUSTOMER, "raw_customers"))
ORACLES["dim_seller"] = _with(_raw("sellers"), _typed(s.DIM_SELLER, "raw_sellers"))
ORACLES["dim_date"] = _with(_raw("orders"), f"select * from ({CALENDAR})")
ORACLES["agg_date_bounds"] = _with(
    _raw("orders"),
    f"select min({_day('order_purchase_timestamp')}) as first_day, max({_day('order_purchase_timestamp')}) as last_day"
    " from raw_orders",
)

# --- facts ------------------------------------------------------------------

for _suffix, _window in (("", FULL), ("_increment", MONTH)):
    ORACLES[f"fact_order{_suffix}"] = _with(
        _raw("orders", "items"), _typed(s.FACT_ORDER, f"({_fact_order(_window)})")
    )
    ORACLES[f"fact_payment{_suffix}"] = _with(
        _raw("orders", "payments"), _typed(s.FACT_PAYMENT, f"({_fact_payment(_window)})")
    )
    ORACLES[f"fact_review{_suffix}"] = _with(
        _raw("orders", "reviews"), _typed(s.FACT_REVIEW, f"({_fact_review(_window)})")
    )

_REDELIVERED = _inside("order_purchase_timestamp", MONTH)
_LATEST = {
    **_raw("items"),
    "every_order": raw_sql("orders"),
    "raw_orders": "select * replace (case when "
    + _REDELIVERED
    + " then order_delivered_customer_date end as order_delivered_customer_date) from every_order",
}
ORACLES["fact_order_latest"] = _with(
    _LATEST,
    _typed(
        s.FACT_ORDER,
        f"({_fact_order(FULL)})",
        f", case when {_REDELIVERED} then '{LATER_DT}' else '{EARLIER_DT}' end as dt",
    ),
)

# --- summaries --------------------------------------------------------------


def _summary(parts: dict[str, str], table: Table, sql: str) -> str:
    return _with(parts, _typed(table, f"({sql})"))


def _by_category(blank_unnamed: bool, only: str = "true") -> str:
    named = (
        "(select f.*, product_category_en as cate_name from fact_order f join dim_product p"
        " on p.product_id = f.product_id)"
    )
    parts = {**_raw("products", "translation"), **_FACT, "dim_product": DIM_PRODUCT}
    sql = _order_summary(["cate_name"], "cate_", "cate", named, blank_unnamed, only)
    return _summary(parts, s.SUM_ORDER_BY_CATEGORY, sql)


_ORDER_BY_DATE = _order_summary(["date_id"], "", "daily", "fact_order")
ORACLES["sum_order_by_date"] = _summary(_FACT, s.SUM_ORDER_BY_DATE, _ORDER_BY_DATE)
ORACLES["sum_order_by_date_daily"] = _summary(
    _FACT,
    s.SUM_ORDER_BY_DATE,
    _order_summary(["date_id"], "", "daily", f"(select * from fact_order where date_id = '{DAY}')"),
)
ORACLES["sum_order_by_date_daily_with_history"] = _summary(
    _FACT,
    s.SUM_ORDER_BY_DATE,
    _order_summary(["date_id"], "", "daily", "fact_order", only=f"date_id = '{DAY}'"),
)
ORACLES["sum_order_by_date_latest"] = _summary({**_LATEST, "fact_order": _fact_order(FULL)}, s.SUM_ORDER_BY_DATE, _ORDER_BY_DATE)
ORACLES["sum_order_by_date_by_person"] = _summary(
    {**_raw("customers"), **_FACT},
    s.SUM_ORDER_BY_DATE,
    _order_summary(
        ["date_id"],
        "",
        "daily",
        "(select f.* replace (coalesce(customer_unique_id, f.customer_id) as customer_id)"
        " from fact_order f left join raw_customers c on c.customer_id = f.customer_id)",
    ),
)
ORACLES["sum_order_by_category"] = _by_category(blank_unnamed=False)
ORACLES["sum_order_by_category_as_written"] = _by_category(blank_unnamed=True)
ORACLES["sum_order_by_category_daily_with_history"] = _by_category(False, only=f"date_id = '{DAY}'")

for _suffix, _kept in (("", KEPT_ORDERS), ("_as_written", EACH_ITEM)):
    ORACLES[f"sum_payment_by_date{_suffix}"] = _summary(
        _PAYMENT, s.SUM_PAYMENT_BY_DATE, _payment_summary(f"select * from fact_payment {_kept}")
    )
    ORACLES[f"sum_review_by_date{_suffix}"] = _summary(
        _REVIEW, s.SUM_REVIEW_BY_DATE, _review_summary(f"select * from fact_review {_kept}")
    )


def _by_region(side: str, table: Table) -> str:
    keys = [f"{side}_state", f"{side}_city"]
    located = (
        f"(select f.*, {', '.join(keys)} from fact_order f left join raw_{side}s d on d.{side}_id = f.{side}_id)"
    )
    return _summary({**_raw(f"{side}s"), **_FACT}, table, _order_summary(keys, "region_", "region", located))


ORACLES["sum_order_by_customer_region"] = _by_region("customer", s.SUM_ORDER_BY_CUSTOMER_REGION)
ORACLES["sum_order_by_seller_region"] = _by_region("seller", s.SUM_ORDER_BY_SELLER_REGION)
ORACLES["sum_order_status_by_date"] = _summary(_raw("orders"), s.SUM_STATUS_BY_DATE, STATUS_SUMMARY)

ORACLES["board_daily"] = _with(
    {
        **_PAYMENT,
        **_REVIEW,
        "calendar": CALENDAR,
        "o": _typed(s.SUM_ORDER_BY_DATE, f"({_ORDER_BY_DATE})"),
        "st": _typed(s.SUM_STATUS_BY_DATE, f"({STATUS_SUMMARY})"),
        "p": _typed(s.SUM_PAYMENT_BY_DATE, f"({_payment_summary(f'select * from fact_payment {KEPT_ORDERS}')})"),
        "r": _typed(s.SUM_REVIEW_BY_DATE, f"({_review_summary(f'select * from fact_review {KEPT_ORDERS}')})"),
    },
    """select calendar.date_id, year, month, is_weekend,
        o.* exclude (date_id), st.* exclude (date_id), p.* exclude (date_id), r.* exclude (date_id)
    from calendar left join o using (date_id) left join st using (date_id)
        left join p using (date_id) left join r using (date_id)
    where o.date_id is not null or st.date_id is not null or p.date_id is not null or r.date_id is not null""",
)

for _table in s.BOARDS:
    ORACLES[_table.name.removesuffix("_1d")] = f"select {', '.join(_table.names)} from ({ORACLES['board_daily']})"

# --- stored tables ----------------------------------------------------------


def _copies(name: str, dts: Iterable[str]) -> str:
    return " union all ".join(_typed(s.RAW[name], f"raw_{name}", _dated(dt)) for dt in dts)


ORACLES["scan_snapshot_partition"] = ORACLES["dim_customer"]
ORACLES["load_overwrite_partition"] = _with(_raw("orders"), _copies("orders", [EARLIER_DT, LATER_DT]))
ORACLES["load_append_partition"] = _with(_raw("orders"), _copies("orders", [EARLIER_DT, LATER_DT, LATER_DT]))

# --- single rules -----------------------------------------------------------

ORACLES["filter_time_window"] = _with(
    _raw("orders"),
    f"select order_id, cast(order_purchase_timestamp as varchar) as order_purchase_timestamp from {_BOUGHT}",
)
ORACLES["filter_order_status"] = _with(
    _raw("orders"), f"select order_id, order_status from raw_orders where {SOUND_STATUS}"
)
ORACLES["filter_valid_measures"] = _with(
    _raw("items"),
    "select order_id, order_item_id, cast(price as double) as price, cast(freight_value as double) as freight_value"
    f" from raw_items where {SOUND_MEASURES}",
)
ORACLES["flag_overtime"] = _with(_raw("orders"), f"select order_id, {LATE} as is_overtime from raw_orders")
ORACLES["agg_count_distinct"] = _with(
    _FACT,
    "select date_id, count(distinct order_id) as order_count, count(distinct customer_id) as customer_count"
    " from fact_order group by date_id",
)
ORACLES["agg_conditional_distinct"] = _with(
    _FACT,
    "select date_id, count(distinct customer_id) filter (where first_day) as new_customer_count,"
    " count(distinct customer_id) as customer_count from (select date_id, customer_id,"
    " date_id = min(date_id) over (partition by customer_id) as first_day from fact_order) group by date_id",
)
ORACLES["agg_order_level"] = _with(
    _FACT,
    "select date_id, order_id, cast(sum(total_amount) as double) as order_amount, count(*) as item_rows,"
    " cast(max(deliver_duration) as integer) as deliver_duration,"
    f" cast(max(total_duration) as integer) as total_duration, max({LATE}) as is_overtime"
    " from fact_order group by date_id, order_id",
)
_SPLIT = f"coalesce(sum({_cents('payment_value')}) filter (where is_installment = 1), 0)"
ORACLES["agg_conditional_share"] = _with(
    {**_raw("orders", "payments"), "fact_payment": _fact_payment(FULL)},
    f"select date_id, {_rate(_SPLIT, 'sum(' + _cents('payment_value') + ')')} as installment_gmv_rate"
    " from fact_payment group by date_id",
)
ORACLES["window_item_count"] = _with(_FACT, "select order_id, order_item_id, item_count from fact_order")
ORACLES["window_order_total"] = _with(
    _FACT,
    "select order_id, order_item_id, cast(total_amount as double) as total_amount,"
    " cast(order_total_amount as double) as order_total_amount from fact_order",
)
ORACLES["window_payment_attempts"] = _with(
    {**_raw("orders", "payments"), "fact_payment": _fact_payment(FULL)},
    "select order_id, payment_sequential, payment_attempts from fact_payment",
)
ORACLES["window_new_customer"] = _with(
    _FACT,
    "select customer_id, date_id, max(cast(first_day as integer)) as is_new, count(*) as item_rows"
    " from (select customer_id, date_id, date_id = min(date_id) over (partition by customer_id) as first_day"
    " from fact_order) group by customer_id, date_id",
)
_DATE = "cast(order_purchase_timestamp as date)"
ORACLES["fn_date_parts"] = _with(
    _raw("orders"),
    f"select order_id, cast({_DATE} as varchar) as date_id, cast(year({_DATE}) as integer) as year,"
    f" cast(quarter({_DATE}) as integer) as quarter, cast(month({_DATE}) as integer) as month,"
    f" cast(day({_DATE}) as integer) as day, cast(dayofweek({_DATE}) in (0, 6) as integer) as is_weekend"
    " from raw_orders",
)
ORACLES["fn_durations"] = _with(
    _raw("orders"),
    f"select order_id, cast({_days('order_delivered_carrier_date', 'order_delivered_customer_date')} as integer)"
    " as deliver_duration,"
    f" cast({_days('order_purchase_timestamp', 'order_delivered_customer_date')} as integer) as total_duration"
    " from raw_orders",
)
_MINUTES = "datesub('minute', review_creation_date, review_answer_timestamp)"
ORACLES["fn_hours_to_reply"] = _with(
    _raw("reviews"),
    f"select review_id, {_MINUTES} as minutes_to_reply, cast(round({_MINUTES} / 60.0) as integer) as hours_to_reply"
    " from raw_reviews",
)
ORACLES["fn_comment_length"] = _with(
    _raw("reviews"),
    "select review_id, cast(length(review_comment_message) as integer) as comment_count,"
    " cast(coalesce(review_comment_message, '') <> '' as integer) as has_comment from raw_reviews",
)
ORACLES["fn_score_bucket"] = _with(
    _raw("reviews"),
    "select review_id, review_score, cast(case when review_score < 3 then 1 when review_score > 3 then 3 else 2 end"
    " as integer) as score_bucket from raw_reviews where review_score >= 1 and review_score <= 5",
)

# --- quality ----------------------------------------------------------------

BROKEN = {
    "orders": {
        "order_id missing": "order_id is null",
        "customer_id missing": "customer_id is null",
        "status missing": "order_status is null",
        "status void": "order_status in ('canceled', 'unavailable')",
        "purchase time missing": "order_purchase_timestamp is null",
    },
    "items": {
        "order_id missing": "order_id is null",
        "order_item_id missing": "order_item_id is null",
        "product_id missing": "product_id is null",
        "seller_id missing": "seller_id is null",
        "price missing": "price is null",
        "price negative": "price < 0",
        "freight missing": "freight_value is null",
        "freight negative": "freight_value < 0",
    },
    "payments": {
        "order_id missing": "order_id is null",
        "payment_sequential missing": "payment_sequential is null",
        "payment_sequential below 1": "payment_sequential < 1",
        "instalments missing": "payment_installments is null",
        "instalments zero": "payment_installments = 0",
        "value missing": "payment_value is null",
        "value negative": "payment_value < 0",
    },
    "reviews": {
        "order_id missing": "order_id is null",
        "review_id missing": "review_id is null",
        "score missing": "review_score is null",
        "score out of range": "review_score not between 1 and 5",
        "creation time missing": "review_creation_date is null",
    },
}


def _broken(name: str) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, '{rule}' as rule, count(*) as checked_rows,"
        f" count(*) filter (where {condition}) as failed_rows from raw_{name}"
        for rule, condition in BROKEN[name].items()
    )


def _unknown(name: str) -> str:
    return (
        f"select '{name}' as table_name, 'order unknown' as rule, count(*) as checked_rows,"
        " count(*) filter (where order_id not in (select order_id from raw_orders)) as failed_rows"
        f" from raw_{name} where order_id is not null"
    )


ORACLES["quality_order_rules"] = _with(
    _raw("orders", "items"), f"{_broken('orders')} union all {_broken('items')} union all {_unknown('items')}"
)
ORACLES["quality_payment_rules"] = _with(
    _raw("orders", "payments"), f"{_broken('payments')} union all {_unknown('payments')}"
)
ORACLES["quality_review_rules"] = _with(
    _raw("orders", "reviews"), f"{_broken('reviews')} union all {_unknown('reviews')}"
)
_CHECKED = [name for name, table in s.RAW.items() if table.key]


def _shown(key: str) -> str:
    return f"coalesce(cast({key} as varchar), '\\N')"


ORACLES["quality_duplicate_keys"] = _with(
    _raw(*_CHECKED),
    " union all ".join(
        f"select '{name}' as table_name, concat_ws('|', {', '.join(_shown(key) for key in s.RAW[name].key)}) as key_value,"
        f" count(*) as n_rows from raw_{name} group by {', '.join(s.RAW[name].key)} having count(*) > 1"
        for name in _CHECKED
    ),
)


def _key(name: str, source: str = "") -> str:
    return f"concat_ws('|', {', '.join(_shown(source + key) for key in s.RAW[name].key)})"


def _rejected(name: str) -> str:
    rules = ", ".join(f"case when {condition} then '{rule}' end" for rule, condition in BROKEN[name].items() if rule != "instalments zero")
    return f"select * from (select '{name}' as table_name, {_key(name)} as key_value, concat_ws('; ', {rules}) as broken_rules from raw_{name}) where broken_rules <> ''"


ORACLES["rejected_rows"] = _with(_raw(*BROKEN), " union all ".join(_rejected(name) for name in BROKEN))


def _states(*names: str) -> dict[str, str]:
    return {f"{when}_{name}": state_sql(when, name) for name in names for when in ("before", "now")}


def _differing(name: str) -> str:
    """All rows of a key as one sorted text, compared."""
    keys = ", ".join(s.RAW[name].key)
    sides = [f"{w} as (select {keys}, count(*) as n, list_sort(list(cast(t as varchar))) as r from {w}_{name} t group by {keys})" for w in ("before", "now")]
    same = " and ".join(f"before.{k} is not distinct from now.{k}" for k in s.RAW[name].key)
    key = _key(name, "now.")
    return f"""(with {', '.join(sides)}
        select '{name}' as table_name, case when now.n is null then {_key(name, 'before.')} else {key} end as key_value,
            case when before.n is null then 'inserted' when now.n is null then 'removed' else 'changed' end as change,
            coalesce(before.n, 0) as rows_before, coalesce(now.n, 0) as rows_now
        from before full join now on {same} where before.r is distinct from now.r)"""


_COMPARED = ("orders", "items", "payments")
ORACLES["snapshot_difference"] = _with(_states(*_COMPARED), " union all ".join(f"select * from {_differing(name)}" for name in _COMPARED))
ORACLES["late_rows"] = _with(
    _states("payments"),
    "select * replace (cast(payment_value as double) as payment_value) from ("
    "(select * from now_payments union all select * from now_payments where cast(order_id as bigint) % 23 = 0)"
    " except all select * from before_payments)",
)


def _snapshot_intervals(days: list[str]) -> str:
    """A copy of a row begins on a day whose day before lacks it, and ends at the next day that lacks it."""
    columns = ", ".join(s.PAYMENTS.names)
    every = " union all ".join(f"select *, {n} as d from {SNAPSHOTS[dt]}_payments" for n, dt in enumerate(days))
    at = f"[{', '.join(repr(dt) for dt in days)}]"
    parts = {
        "copies": f"select *, row_number() over (partition by {columns}, d) as k from ({every})",
        "seen": f"select {columns}, k, list(d) as ds from copies group by {columns}, k",
        "begun": f"select *, unnest(list_filter(ds, lambda d: not list_contains(ds, d - 1))) as d from seen",
    }
    gone = f"list_min(list_filter(range({len(days)}), lambda e: e > d and not list_contains(ds, e)))"
    shown = columns.replace("payment_value", "cast(payment_value as double) as payment_value")
    return _with(_states("payments") | parts, f"select {shown}, {at}[d + 1] as valid_from, {at}[{gone} + 1] as valid_to from begun")


ORACLES["snapshot_intervals"] = _snapshot_intervals(sorted(SNAPSHOTS))
ORACLES["snapshot_as_of"] = _with(_states("payments"), f"select * replace (cast(payment_value as double) as payment_value) from {SNAPSHOTS[EARLIER_DT]}_payments")

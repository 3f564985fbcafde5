"""Test tables read as the nine raw tables.

The driver's tables are no shop data, so each raw column is an expression over
them. The expressions mean the same in Spark SQL and in DuckDB and are shared
with the checking SQL, so both engines start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.schemas import RAW, TRANSLATION

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

FROM = {
    "orders": ("orders",),
    "items": ("lineitem",),
    "payments": ("lineitem",),
    "reviews": ("documents", ("orders", "doc_id = o_orderkey")),
    "products": ("part",),
    "customers": ("customer", ("nation", "c_nationkey = n_nationkey"), ("region", "n_regionkey = r_regionkey")),
    "sellers": ("supplier", ("nation", "s_nationkey = n_nationkey"), ("region", "n_regionkey = r_regionkey")),
    "geolocation": ("nation", ("region", "n_regionkey = r_regionkey")),
}

COLUMNS = {
    "orders": {
        "order_id": "cast(o_orderkey as string)",
        "customer_id": "cast(o_custkey as string)",
        "order_status": "case when o_orderkey % 50 = 0 then 'canceled' when o_orderkey % 50 = 1 then 'unavailable'"
        " when o_orderkey % 101 = 2 then null when o_orderstatus = 'F' then 'delivered'"
        " when o_orderstatus = 'O' then 'shipped' else 'approved' end",
        "order_purchase_timestamp": "o_orderdate + interval '1' hour * cast(o_orderkey % 24 as int)",
        "order_approved_at": "o_orderdate + interval '1' hour * cast(o_orderkey % 24 + 2 as int)",
        "order_delivered_carrier_date": "case when o_orderstatus in ('F', 'O')"
        " then o_orderdate + interval '1' day * cast(1 + o_orderkey % 5 as int) end",
        "order_delivered_customer_date": "case when o_orderstatus = 'F'"
        " then o_orderdate + interval '1' day * cast(2 + o_orderkey % 5 + o_orderkey % 23 as int) end",
        "order_estimated_delivery_date": "o_orderdate + interval '1' day * 20",
    },
    "items": {
        "order_id": "cast(l_orderkey as string)",
        "order_item_id": "l_linenumber",
        "product_id": "cast(l_partkey as string)",
        "seller_id": "cast(l_suppkey as string)",
        "shipping_limit_date": "l_shipdate",
        "price": "case when (l_orderkey + l_linenumber) % 97 = 0 then null"
        " when (l_orderkey + l_linenumber) % 89 = 0 then cast(-l_extendedprice as decimal(10,2))"
        " else cast(l_extendedprice as decimal(10,2)) end",
        "freight_value": "cast(l_quantity as decimal(10,2))",
    },
    "payments": {
        "order_id": "cast(l_orderkey as string)",
        "payment_sequential": "l_linenumber - 1",
        "payment_type": "case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto' else 'voucher' end",
        "payment_installments": "cast(l_quantity as int) % 6",
        "payment_value": "case when (l_orderkey + l_linenumber) % 83 = 0 then null"
        " else cast(l_extendedprice as decimal(10,2)) end",
    },
    "reviews": {
        "review_id": "concat('r', cast(doc_id as string))",
        "order_id": "cast(doc_id as string)",
        "review_score": "case when doc_id % 61 = 0 then null when doc_id % 59 = 0 then 0"
        " else cast(1 + doc_id % 5 as int) end",
        "review_comment_title": "source",
        "review_comment_message": "case when doc_id % 4 = 0 then null when doc_id % 4 = 1 then '' else text end",
        "review_creation_date": "o_orderdate + interval '1' day * cast(doc_id % 40 as int)",
        "review_answer_timestamp": "case when doc_id % 6 <> 0 then o_orderdate"
        " + interval '1' day * cast(doc_id % 40 as int) + interval '1' minute * cast(n_chars as int) end",
    },
    "products": {
        "product_id": "cast(p_partkey as string)",
        "product_category_name": "case when p_partkey % 53 = 0 then null else p_brand end",
        "product_name_lenght": "cast(length(p_name) as int)",
        "product_description_lenght": "cast(length(p_type) as int)",
        "product_photos_qty": "cast(p_partkey % 5 as int)",
        "product_weight_g": "p_size * 100",
        "product_length_cm": "p_size",
        "product_height_cm": "p_size + 1",
        "product_width_cm": "p_size + 2",
    },
    "customers": {
        "customer_id": "cast(c_custkey as string)",
        "customer_unique_id": "concat('u', cast(c_custkey % 1000 as string))",
        "customer_zip_code_prefix": "lpad(cast(c_nationkey as string), 5, '0')",
        "customer_city": "n_name",
        "customer_state": "r_name",
    },
    "sellers": {
        "seller_id": "cast(s_suppkey as string)",
        "seller_zip_code_prefix": "lpad(cast(s_nationkey as string), 5, '0')",
        "seller_city": "n_name",
        "seller_state": "r_name",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "lpad(cast(n_nationkey as string), 5, '0')",
        "geolocation_lat": "cast(n_nationkey as double) - 12.0",
        "geolocation_lng": "cast(n_nationkey as double) * 2 - 60.0",
        "geolocation_city": "n_name",
        "geolocation_state": "r_name",
    },
}

# One brand stays without translation, so the fallback to the source name shows.
UNTRANSLATED = "Brand#13"
TRANSLATION_COLUMNS = {
    "col_1": "p_brand",
    "col_2": "replace(p_brand, 'Brand#', 'category_')",
}


_ID = "cast(order_id as bigint)"

#: Two states of the sources that differ in every way: rows only there (``where``), columns that changed (``columns``).
#: Payments of some orders have no running number, so that their keys are NULL and repeat.
STATES = {
    "before": {
        "orders": (f"{_ID} % 9 <> 0", {"order_status": f"case when {_ID} % 7 = 0 then 'approved' else order_status end"}),
        "items": (f"{_ID} % 9 <> 0 and ({_ID} % 10 <> 1 or order_item_id < 3)", {"price": f"cast(case when {_ID} % 13 = 0 then price + 1 else price end as decimal(10,2))"}),
        "payments": (f"{_ID} % 9 <> 0 and ({_ID} % 5 <> 2 or payment_sequential < 2)", {"payment_sequential": f"case when {_ID} % 19 = 0 then null else payment_sequential end"}),
    },
    "now": {
        "orders": (f"{_ID} % 17 <> 0", {}),
        "items": (f"{_ID} % 17 <> 0", {}),
        "payments": (f"{_ID} % 17 <> 0", {"payment_sequential": f"case when {_ID} % 19 = 0 then null else payment_sequential end"}),
    },
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The schema is given, so no job runs to look it up in the files."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def headerless_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The translation source as it arrives: positional column names only."""
    brands = table(spark, sf_dir, "part").where(f"p_brand <> '{UNTRANSLATED}'").select("p_brand").distinct()
    return brands.selectExpr(*[f"{sql} as {name}" for name, sql in TRANSLATION_COLUMNS.items()])


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table by its short name, columns in declared order."""
    if name == "translation":
        return headerless_translation(spark, sf_dir).toDF(*TRANSLATION.names)
    first, *others = FROM[name]
    rows = table(spark, sf_dir, first)
    for other, condition in others:
        left, right = condition.split(" = ")
        joined = table(spark, sf_dir, other)
        rows = rows.join(joined, rows[left] == joined[right])
    columns = COLUMNS[name]
    return rows.selectExpr(*[f"{columns[column]} as {column}" for column in RAW[name].names])


def raw_sql(name: str) -> str:
    """The same raw table as a DuckDB query over the registered views."""
    if name == "translation":
        columns = ", ".join(
            f"{sql} as {column}" for column, sql in zip(TRANSLATION.names, TRANSLATION_COLUMNS.values())
        )
        return f"select distinct {columns} from part where p_brand <> '{UNTRANSLATED}'"
    first, *others = FROM[name]
    joins = "".join(f" join {other} on {condition}" for other, condition in others)
    columns = ", ".join(f"{COLUMNS[name][column]} as {column}" for column in RAW[name].names)
    return f"select {columns} from {first}{joins}"


def state(spark: SparkSession, sf_dir: str, when: str, name: str) -> DataFrame:
    """A raw table in one of the ``STATES``."""
    where, columns = STATES[when][name]
    return raw(spark, sf_dir, name).where(where).selectExpr(*[f"{columns.get(c, c)} as {c}" for c in RAW[name].names])


def state_sql(when: str, name: str) -> str:
    where, columns = STATES[when][name]
    return f"select {', '.join(f'{columns.get(c, c)} as {c}' for c in RAW[name].names)} from ({raw_sql(name)}) where {where}"

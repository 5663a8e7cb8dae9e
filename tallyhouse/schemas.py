"""Declared layouts of the staging, dimension, fact and reject tables.

Surrogate keys are BIGINT: a 32-bit sequence runs out long before the row
counts this is meant for.  Money is DECIMAL throughout.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Lineage columns carried by every staging table.
LINEAGE = ["file_source", "loaded_at", "ingest_seq"]

# Staging columns: fixed values, the layout the source departments deliver.
STAGING = {
    "campaign_data": "campaign_id STRING, campaign_name STRING, campaign_description STRING, discount DECIMAL(10,2)",
    "transactional_campaign_data": "transaction_id STRING, user_id STRING, campaign_id STRING, order_id STRING, availed INT",
    "order_data": "order_id STRING, user_id STRING, transaction_date DATE, payment_method STRING, "
    "total_amount DECIMAL(10,2), estimated_arrival_days INT, staff_id STRING",
    "line_item_data_prices": "line_item_id STRING, order_id STRING, quantity INT, discount DECIMAL(10,2), price DECIMAL(10,2)",
    "line_item_data_products": "line_item_id STRING, order_id STRING, product_id STRING",
    "order_delays": "order_id STRING, delay_days INT",
    "product_list": "product_id STRING, product_name STRING, product_type STRING, price DECIMAL(10,2)",
    "user_data": "user_id STRING, name STRING, street STRING, state STRING, city STRING, country STRING, "
    "birthdate DATE, gender STRING, device_address STRING, user_type STRING, creation_date TIMESTAMP_NTZ",
    "user_job": "user_id STRING, job_title STRING, job_level STRING",
    "user_credit_card": "user_id STRING, name STRING, credit_card_number STRING, issuing_bank STRING",
    "merchant_data": "merchant_id STRING, name STRING, street STRING, state STRING, city STRING, country STRING, "
    "contact_number STRING, creation_date TIMESTAMP_NTZ",
    "staff_data": "staff_id STRING, name STRING, street STRING, state STRING, city STRING, country STRING, "
    "job_level STRING, contact_number STRING, creation_date TIMESTAMP_NTZ",
    "order_with_merchant_data": "order_id STRING, merchant_id STRING, staff_id STRING",
}

DEPARTMENT = {
    "campaign_data": "marketing",
    "transactional_campaign_data": "marketing",
    "order_data": "operations",
    "line_item_data_prices": "operations",
    "line_item_data_products": "operations",
    "order_delays": "operations",
    "product_list": "business",
    "user_data": "customer_management",
    "user_job": "customer_management",
    "user_credit_card": "customer_management",
    "merchant_data": "enterprise",
    "staff_data": "enterprise",
    "order_with_merchant_data": "enterprise",
}

WAREHOUSE = {
    "dim_date": "date_sk INT, date DATE, year INT, month INT, month_name STRING, day INT, quarter STRING",
    "dim_campaign": "campaign_sk BIGINT, campaign_id STRING, campaign_name STRING, campaign_description STRING, "
    "discount DECIMAL(10,2)",
    "dim_product": "product_sk BIGINT, product_id STRING, product_name STRING, product_type STRING, price DECIMAL(10,2)",
    "dim_user": "user_sk BIGINT, user_id STRING, name STRING, street STRING, state STRING, city STRING, country STRING, "
    "birthdate DATE, gender STRING, device_address STRING, user_type STRING, creation_date TIMESTAMP_NTZ",
    "dim_staff": "staff_sk BIGINT, staff_id STRING, name STRING, street STRING, state STRING, city STRING, country STRING, "
    "job_level STRING, contact_number STRING, creation_date TIMESTAMP_NTZ",
    "dim_merchant": "merchant_sk BIGINT, merchant_id STRING, name STRING, street STRING, state STRING, city STRING, "
    "country STRING, contact_number STRING, creation_date TIMESTAMP_NTZ",
    "dim_user_job": "user_job_sk BIGINT, user_id STRING, job_title STRING, job_level STRING",
    "dim_credit_card": "credit_card_sk BIGINT, user_id STRING, name STRING, credit_card_number STRING, issuing_bank STRING",
    "fact_orders": "order_id STRING, user_sk BIGINT, merchant_sk BIGINT, staff_sk BIGINT, transaction_date_sk INT, "
    "estimated_arrival_days INT, delay_days INT",
    "fact_line_items": "order_id STRING, product_sk BIGINT, user_sk BIGINT, merchant_sk BIGINT, staff_sk BIGINT, "
    "transaction_date_sk INT, price DECIMAL(10,2), quantity INT",
    "fact_campaign_transactions": "order_id STRING, campaign_sk BIGINT, user_sk BIGINT, merchant_sk BIGINT, "
    "transaction_date_sk INT, availed INT",
    "reject_fact_orders": "order_id STRING, user_id STRING, merchant_id STRING, staff_id STRING, transaction_date STRING, "
    "error_reason STRING, source_file STRING, rejected_at TIMESTAMP_NTZ, raw_data STRING",
    "reject_fact_line_items": "order_id STRING, product_id STRING, line_item_id STRING, error_reason STRING, "
    "source_file STRING, rejected_at TIMESTAMP_NTZ, raw_data STRING",
    "reject_fact_campaign_transactions": "order_id STRING, user_id STRING, campaign_id STRING, transaction_date STRING, "
    "error_reason STRING, source_file STRING, rejected_at TIMESTAMP_NTZ, raw_data STRING",
}

# dimension -> (surrogate key, business key)
DIM_KEYS = {
    "dim_campaign": ("campaign_sk", "campaign_id"),
    "dim_product": ("product_sk", "product_id"),
    "dim_user": ("user_sk", "user_id"),
    "dim_staff": ("staff_sk", "staff_id"),
    "dim_merchant": ("merchant_sk", "merchant_id"),
}

INGESTION_LOG = (
    "file_path STRING, table_name STRING, rows_ingested BIGINT, status STRING, message STRING, ts TIMESTAMP"
)

# rows of source files that do not fit their header
REJECTED_ROWS = "file_source STRING, ingest_seq BIGINT, record STRING, reason STRING, dataset STRING"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def staging_schema(dataset: str, lineage: bool = True) -> T.StructType:
    ddl = STAGING[dataset]
    if lineage:
        ddl += ", file_source STRING, loaded_at TIMESTAMP, ingest_seq BIGINT"
    return struct(ddl)


def warehouse_schema(table: str) -> T.StructType:
    return struct(WAREHOUSE[table])


def staging_table(dataset: str) -> str:
    return f"stg_{DEPARTMENT[dataset]}_department_{dataset}"


def attributes(dim: str) -> list[str]:
    """Columns of a dimension other than its two keys."""
    sk, key = DIM_KEYS[dim]
    return [f.name for f in warehouse_schema(dim).fields if f.name not in (sk, key)]

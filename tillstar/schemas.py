"""Column contracts of every table, as explicit Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema of a column list; usable before a session exists."""
    fields = []
    for column in columns.split(", "):
        name, kind = column.split(" ")
        if kind.startswith("DECIMAL("):
            precision, scale = kind.removeprefix("DECIMAL(").removesuffix(")").split(",")
            fields.append(T.StructField(name, T.DecimalType(int(precision), int(scale))))
        else:
            fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


AUDIT = "source_file STRING, load_timestamp TIMESTAMP_NTZ, row_hash STRING, load_id BIGINT"

# The source tables, their file globs and their columns.
_SOURCES = {
    "stg_crm_customers": (
        "crm_customers_*.csv",
        "customer_id STRING, first_name STRING, last_name STRING, email STRING, phone_number STRING, "
        "date_of_birth DATE, gender STRING, address STRING, city STRING, state STRING, postal_code STRING, "
        "country STRING, registration_date DATE, customer_segment STRING, account_status STRING",
    ),
    "stg_products": (
        "products_*.csv",
        "product_id STRING, product_name STRING, product_category STRING, product_subcategory STRING, "
        "brand STRING, unit_cost DECIMAL(10,2), retail_price DECIMAL(10,2), product_status STRING",
    ),
    "stg_ecom_transactions": (
        "ecom_transactions_*.csv",
        "transaction_id STRING, customer_id STRING, transaction_date TIMESTAMP_NTZ, order_number STRING, "
        "payment_method STRING, payment_status STRING, total_amount DECIMAL(12,2), tax_amount DECIMAL(10,2), "
        "shipping_amount DECIMAL(10,2), discount_amount DECIMAL(10,2), currency_code STRING",
    ),
    "stg_ecom_transaction_items": (
        "ecom_transaction_items_*.csv",
        "transaction_item_id STRING, transaction_id STRING, product_id STRING, product_name STRING, "
        "quantity INT, unit_price DECIMAL(10,2), line_total DECIMAL(12,2), discount_amount DECIMAL(12,2)",
    ),
    "stg_marketing_campaigns": (
        "marketing_campaigns_*.csv",
        "campaign_id STRING, campaign_name STRING, campaign_type STRING, channel STRING, start_date DATE, "
        "end_date DATE, budget DECIMAL(12,2), target_audience STRING, campaign_status STRING",
    ),
    "stg_campaign_responses": (
        "campaign_responses_*.csv",
        "response_id STRING, campaign_id STRING, customer_id STRING, response_date DATE, "
        "response_type STRING, conversion_value DECIMAL(10,2)",
    ),
}

SOURCE_GLOB = {name: glob for name, (glob, _) in _SOURCES.items()}
SOURCE = {name: _struct(ddl) for name, (_, ddl) in _SOURCES.items()}
STAGING = {name: _struct(f"{ddl}, {AUDIT}") for name, (_, ddl) in _SOURCES.items()}

AUDIT_LOG = _struct(
    "load_id BIGINT, table_name STRING, load_type STRING, source_file STRING, rows_loaded BIGINT, "
    "rows_rejected BIGINT, load_start_time TIMESTAMP_NTZ, load_end_time TIMESTAMP_NTZ, load_status STRING, "
    "error_message STRING, loaded_by STRING"
)

# Money totals are kept as DECIMAL(28,2): a hot customer over a full history does not fit (12,2).
# Columns and types of the warehouse tables.
WAREHOUSE = {
    name: _struct(ddl)
    for name, ddl in {
        "dim_customer": (
            "customer_key BIGINT, customer_id STRING, first_name STRING, last_name STRING, full_name STRING, "
            "email STRING, phone_number STRING, date_of_birth DATE, age INT, age_group STRING, gender STRING, "
            "address STRING, city STRING, state STRING, postal_code STRING, country STRING, "
            "registration_date DATE, customer_segment STRING, account_status STRING, "
            "lifetime_value DECIMAL(28,2), total_orders BIGINT, total_spent DECIMAL(28,2), "
            "valid_from DATE, valid_to DATE, is_current BOOLEAN, source_system STRING"
        ),
        "dim_product": (
            "product_key BIGINT, product_id STRING, product_name STRING, product_category STRING, "
            "product_subcategory STRING, brand STRING, unit_cost DECIMAL(10,2), retail_price DECIMAL(10,2), "
            "margin_percentage DECIMAL(9,2), product_status STRING, is_active BOOLEAN, source_system STRING"
        ),
        "dim_campaign": (
            "campaign_key BIGINT, campaign_id STRING, campaign_name STRING, campaign_type STRING, "
            "channel STRING, start_date DATE, end_date DATE, duration_days INT, budget DECIMAL(12,2), "
            "target_audience STRING, campaign_status STRING, source_system STRING"
        ),
        "dim_date": (
            "date_key INT, date_actual DATE, day_of_week INT, day_name STRING, day_of_month INT, "
            "day_of_year INT, week_of_year INT, week_start_date DATE, week_end_date DATE, month_number INT, "
            "month_name STRING, month_abbr STRING, month_start_date DATE, month_end_date DATE, "
            "quarter_number INT, quarter_name STRING, quarter_start_date DATE, quarter_end_date DATE, "
            "year_number INT, fiscal_year INT, fiscal_quarter INT, fiscal_month INT, is_weekend BOOLEAN, "
            "is_holiday BOOLEAN, holiday_name STRING, is_business_day BOOLEAN"
        ),
        "fact_transactions": (
            "transaction_key BIGINT, customer_key BIGINT, product_key BIGINT, transaction_date_key INT, "
            "transaction_id STRING, order_number STRING, quantity INT, unit_price DECIMAL(10,2), "
            "line_total DECIMAL(12,2), discount_amount DECIMAL(12,2), tax_amount DECIMAL(10,2), "
            "shipping_amount DECIMAL(10,2), net_amount DECIMAL(12,2), payment_method STRING, "
            "payment_status STRING, currency_code STRING, source_system STRING"
        ),
        "fact_campaign_responses": (
            "response_key BIGINT, customer_key BIGINT, campaign_key BIGINT, response_date_key INT, "
            "response_id STRING, response_type STRING, conversion_value DECIMAL(10,2), is_opened BOOLEAN, "
            "is_clicked BOOLEAN, is_converted BOOLEAN, source_system STRING"
        ),
        "agg_customer_monthly": (
            "customer_key BIGINT, year_month INT, total_transactions BIGINT, total_quantity BIGINT, "
            "total_amount DECIMAL(28,2), total_discount DECIMAL(28,2), avg_transaction_value DOUBLE, "
            "month_start_date DATE, month_end_date DATE"
        ),
        "agg_product_daily": (
            "product_key BIGINT, date_key INT, units_sold BIGINT, total_revenue DECIMAL(28,2), "
            "total_cost DECIMAL(28,2), total_profit DECIMAL(28,2), unique_customers BIGINT"
        ),
    }.items()
}

# Declared text widths, checked by the length operator.
TEXT_WIDTHS = {
    "dim_customer": {
        "customer_id": 50, "first_name": 100, "last_name": 100, "full_name": 255, "email": 255,
        "phone_number": 50, "age_group": 20, "gender": 10, "address": 255, "city": 100, "state": 50,
        "postal_code": 20, "country": 50, "customer_segment": 50, "account_status": 20,
    },
    "dim_product": {
        "product_id": 50, "product_name": 255, "product_category": 100, "product_subcategory": 100,
        "brand": 100, "product_status": 20,
    },
    "dim_date": {"day_name": 10, "month_name": 10, "month_abbr": 3, "quarter_name": 2, "holiday_name": 100},
    "dim_campaign": {
        "campaign_id": 50, "campaign_name": 255, "campaign_type": 50, "channel": 50, "target_audience": 100,
        "campaign_status": 20,
    },
    "fact_transactions": {
        "transaction_id": 50, "order_number": 50, "payment_method": 50, "payment_status": 20, "currency_code": 3,
    },
    "fact_campaign_responses": {"response_id": 50, "response_type": 50},
}

# Table constraints, as unique keys, mandatory columns, and references (column, table, key).
CONSTRAINTS = {
    "dim_customer": {
        "unique": (("customer_key",),),
        "not_null": ("customer_id", "valid_from", "valid_to", "is_current"),
        "references": (),
    },
    "dim_product": {"unique": (("product_key",), ("product_id",)), "not_null": ("product_id",), "references": ()},
    "dim_date": {"unique": (("date_key",), ("date_actual",)), "not_null": ("date_actual",), "references": ()},
    "dim_campaign": {"unique": (("campaign_key",), ("campaign_id",)), "not_null": ("campaign_id",), "references": ()},
    "fact_transactions": {
        "unique": (("transaction_key",),),
        "not_null": ("customer_key", "product_key", "transaction_date_key", "transaction_id"),
        "references": (
            ("customer_key", "dim_customer", "customer_key"),
            ("product_key", "dim_product", "product_key"),
            ("transaction_date_key", "dim_date", "date_key"),
        ),
    },
    "fact_campaign_responses": {
        "unique": (("response_key",),),
        "not_null": ("customer_key", "campaign_key", "response_date_key", "response_id"),
        "references": (
            ("customer_key", "dim_customer", "customer_key"),
            ("campaign_key", "dim_campaign", "campaign_key"),
            ("response_date_key", "dim_date", "date_key"),
        ),
    },
    "agg_customer_monthly": {
        "unique": (("customer_key", "year_month"),),
        "not_null": ("customer_key", "year_month"),
        "references": (("customer_key", "dim_customer", "customer_key"),),
    },
    "agg_product_daily": {
        "unique": (("product_key", "date_key"),),
        "not_null": ("product_key", "date_key"),
        "references": (("product_key", "dim_product", "product_key"), ("date_key", "dim_date", "date_key")),
    },
}

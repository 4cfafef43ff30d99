"""The declared shape of one raw export row.

The export is nested Parquet.  It is always read by this schema and never by
inference, so a column that a file lacks comes back NULL and a column nobody
declared is ignored.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
LONG = T.LongType()
REAL = T.DoubleType()
FLAG = T.BooleanType()


def _fields(*parts) -> list[T.StructField]:
    """Text fields from a word list, other fields from (name, type) pairs, in order."""
    fields = []
    for part in parts:
        if isinstance(part, str):
            fields += [T.StructField(name, TEXT) for name in part.split()]
        else:
            fields.append(T.StructField(*part))
    return fields


def _struct(*parts) -> T.StructType:
    return T.StructType(_fields(*parts))


def _bag(value: T.StructType) -> T.ArrayType:
    """A key-value bag: array of (key, value struct)."""
    return T.ArrayType(_struct("key", ("value", value)))


# The names and types of the public export format.
PARAM_VALUE = _struct(
    "string_value", ("int_value", LONG), ("float_value", REAL), ("double_value", REAL)
)
PROPERTY_VALUE = T.StructType(
    PARAM_VALUE.fields + [T.StructField("set_timestamp_micros", LONG)]
)
PARAMS = _bag(PARAM_VALUE)
PROPERTIES = _bag(PROPERTY_VALUE)

DEVICE = _struct(
    "category mobile_brand_name mobile_model_name mobile_marketing_name "
    "mobile_os_hardware_model operating_system operating_system_version vendor_id "
    "advertising_id language is_limited_ad_tracking",
    ("time_zone_offset_seconds", LONG),
    "browser browser_version",
    ("web_info", _struct("browser browser_version hostname")),
)
ECOMMERCE = _struct(
    ("total_item_quantity", LONG),
    ("purchase_revenue_in_usd", REAL), ("purchase_revenue", REAL),
    ("refund_value_in_usd", REAL), ("refund_value", REAL),
    ("shipping_value_in_usd", REAL), ("shipping_value", REAL),
    ("tax_value_in_usd", REAL), ("tax_value", REAL),
    ("unique_items", LONG),
    "transaction_id",
)
ITEM = _struct(
    "item_id item_name item_brand item_variant item_category item_category2 "
    "item_category3 item_category4 item_category5",
    ("price_in_usd", REAL), ("price", REAL), ("quantity", LONG),
    ("item_revenue_in_usd", REAL), ("item_revenue", REAL),
    ("item_refund_in_usd", REAL), ("item_refund", REAL),
    "coupon affiliation location_id item_list_id item_list_name item_list_index "
    "promotion_id promotion_name creative_name creative_slot",
    ("item_params", PARAMS),
)
LAST_CLICK = _struct(
    ("manual_campaign", _struct(
        "campaign_id campaign_name source medium term content source_platform "
        "creative_format marketing_tactic")),
    ("google_ads_campaign", _struct(
        "customer_id account_name campaign_id campaign_name ad_group_id ad_group_name")),
    ("cross_channel_campaign", _struct(
        "campaign_id campaign_name source medium source_platform "
        "default_channel_group primary_channel_group")),
    ("sa360_campaign", _struct(
        "campaign_id campaign_name source medium ad_group_id ad_group_name "
        "creative_format engine_account_name engine_account_type manager_account_name")),
    ("cm360_campaign", _struct(
        "campaign_id campaign_name source medium account_id account_name advertiser_id "
        "advertiser_name creative_id creative_format creative_name creative_type "
        "creative_type_id creative_version placement_id placement_cost_structure "
        "placement_name rendering_id site_id site_name")),
    ("dv360_campaign", _struct(
        "campaign_id campaign_name source medium advertiser_id advertiser_name creative_id "
        "creative_format creative_name exchange_id exchange_name insertion_order_id "
        "insertion_order_name line_item_id line_item_name partner_id partner_name")),
)

RAW = _struct(
    "event_date", ("event_timestamp", LONG), "event_name", ("event_params", PARAMS),
    ("event_previous_timestamp", LONG), ("event_value_in_usd", REAL),
    ("event_bundle_sequence_id", LONG), ("event_server_timestamp_offset", LONG),
    "user_id user_pseudo_id",
    ("privacy_info", _struct("analytics_storage ads_storage uses_transient_token")),
    ("user_properties", PROPERTIES),
    ("user_first_touch_timestamp", LONG),
    ("user_ltv", _struct(("revenue", REAL), "currency")),
    ("device", DEVICE),
    ("geo", _struct("city country continent region sub_continent metro")),
    ("app_info", _struct("id version install_store firebase_app_id install_source")),
    ("traffic_source", _struct("name medium source")),
    "stream_id platform",
    ("event_dimensions", _struct("hostname")),
    ("ecommerce", ECOMMERCE),
    ("items", T.ArrayType(ITEM)),
    ("collected_traffic_source", _struct(
        "manual_campaign_id manual_campaign_name manual_source manual_medium manual_term "
        "manual_content manual_source_platform manual_creative_format "
        "manual_marketing_tactic gclid dclid srsltid")),
    ("is_active_user", FLAG),
    ("batch_event_index", LONG), ("batch_page_id", LONG), ("batch_ordering_id", LONG),
    ("session_traffic_source_last_click", LAST_CLICK),
    ("publisher", _struct(
        ("ad_revenue_in_usd", REAL), "ad_format ad_source_name ad_unit_id")),
    ("event_original_occurrence_timestamp", LONG),
)

# Columns that are never NULL once loaded, and what a missing value becomes.
NON_NULL = {"event_date": "", "event_name": "", "platform": "", "event_timestamp": 0}

# What a load adds to every row.
LOAD_METADATA = T.StructType([
    T.StructField("_dt", T.DateType()),
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_run_id", TEXT),
    T.StructField("_source_table", TEXT),
    T.StructField("_is_intraday", T.IntegerType()),
])
STORED_RAW = T.StructType(RAW.fields + LOAD_METADATA.fields)

# Sort order inside one stored file.
SORT_KEY = ("event_name", "user_pseudo_id", "event_timestamp")

"""Column names and types of the tables."""

from __future__ import annotations

import re

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

PLAIN_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
    "array<string>": ArrayType(StringType()),
}


def data_type(name: str) -> DataType:
    decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return DecimalType(int(decimal[1]), int(decimal[2])) if decimal else PLAIN_TYPES[name]


def columns(text: str) -> StructType:
    """A schema from ``name type`` pairs; unlike a DDL string it needs no running session."""
    schema = StructType()
    for pair in text.split(", "):
        name, type_name = pair.split(" ")
        schema.add(name, data_type(type_name))
    return schema



SRC_CUSTOMERS = columns(
    "cust_id bigint, cust_ref string, given_name string, family_name string, dob date, email string, "
    "tel_home string, tel_mobile string, addr_line1 string, addr_city string, addr_postcode string, "
    "country_iso string, region_code string, acq_channel_code string, created_date date, email_opt_in string, "
    "sms_opt_in string, is_active string, last_modified_date date"
)
SRC_CUSTOMER_SEGMENTS = columns(
    "cust_id bigint, segment_code string, is_primary string, valid_to date"
)
SRC_CAMPAIGN_EVENTS = columns(
    "event_id bigint, cust_id bigint, camp_ref string, event_type_cd string, event_dttm timestamp_ntz, "
    "channel_cd string, offer_code string, revenue_attrib decimal(14,4)"
)
SRC_CAMPAIGNS = columns("camp_ref string, camp_name string")
SRC_INTERACTIONS = columns(
    "interaction_id bigint, cust_id bigint, interaction_type_cd string, interaction_date timestamp_ntz, "
    "channel_cd string, agent_id bigint, resolution_cd string, csat_score decimal(3,1), duration_mins bigint"
)
STG_CUSTOMER_PROFILE = columns(
    "customer_id bigint, customer_code string, first_name string, last_name string, date_of_birth date, "
    "email string, phone string, mobile string, address_line1 string, address_line2 string, city string, "
    "postcode string, country_code string, region_code string, customer_segment string, "
    "acquisition_channel string, registration_date date, is_opted_in_email string, is_opted_in_sms string, "
    "load_date date, etl_status string"
)
STG_CAMPAIGN_EVENTS = columns(
    "event_id bigint, customer_id bigint, campaign_id string, campaign_name string, event_type string, "
    "event_date timestamp_ntz, channel string, offer_code string, revenue_attributed decimal(14,4), load_date date"
)
STG_CUSTOMER_INTERACTIONS = columns(
    "interaction_id bigint, customer_id bigint, interaction_type string, interaction_date timestamp_ntz, "
    "channel string, agent_id bigint, resolution_code string, satisfaction_score decimal(3,1), "
    "duration_minutes bigint, notes string, load_date date"
)
STG_CUSTOMER_SALES = columns(
    "customer_id bigint, lifetime_value decimal(14,2), loyalty_tier string, last_purchase_date date, "
    "region_code string, load_date date"
)
FACT_REGIONAL_SUMMARY = columns(
    "region_code string, summary_date date, total_revenue decimal(18,4), distinct_customers bigint, "
    "avg_basket_size decimal(14,4)"
)
DIM_CUSTOMER_CRM = columns(
    "dim_crm_customer_key bigint, customer_id bigint, customer_code string, full_name string, email string, "
    "phone string, date_of_birth date, postcode string, region_code string, customer_segment string, "
    "acquisition_channel string, is_opted_in_email string, valid_from date, valid_to date, is_current string, "
    "version_num int, created_date date, updated_date date"
)
FACT_CUSTOMER_SCORES = columns(
    "score_key bigint, customer_id bigint, dim_crm_customer_key bigint, score_date date, clv_score decimal(12,4), "
    "churn_risk_score decimal(5,4), propensity_buy_score decimal(5,4), engagement_score decimal(9,4), "
    "segment_code string, segment_label string, batch_run_date date, model_version string, load_batch_id bigint"
)
FACT_CAMPAIGN_PERFORMANCE = columns(
    "perf_key bigint, dim_campaign_key bigint, campaign_id string, performance_date date, total_sent bigint, "
    "total_opened bigint, total_clicked bigint, total_converted bigint, total_unsubscribed bigint, "
    "revenue_attributed decimal(18,4), open_rate decimal(14,6), click_rate decimal(14,6), "
    "conversion_rate decimal(14,6), load_date date"
)
FACT_CUSTOMER_SEGMENT_SUMMARY = columns(
    "segment_summary_key bigint, segment_code string, region_code string, summary_date date, "
    "customer_count bigint, avg_clv_score decimal(12,4), avg_churn_risk decimal(8,6), high_value_count bigint, "
    "at_risk_count bigint, total_retail_spend decimal(28,4), total_campaign_spend decimal(14,4), load_date date"
)
SCORING_FEATURE_CONFIG = columns(
    "feature_name string, sql_expression string, feature_weight double, source_table string, "
    "aggregation_window_days int, model_version string, target_segment string, is_active string, "
    "execution_order int"
)
AUDIT_MESSAGES = columns(
    "workflow_name string, job_name string, run_date date, status string, rows_processed bigint, "
    "message_ts timestamp_ntz"
)
ETL_JOB_AUDIT = columns(
    "workflow_name string, job_name string, run_date date, status string, rows_processed bigint, "
    "created_date timestamp_ntz, updated_date timestamp_ntz"
)
DEPENDENCY_EDGES = columns(
    "object_owner string, object_name string, object_type string, ref_owner string, ref_name string, ref_type string"
)
GRANTS = columns(
    "source_schema string, source_table string, target_schema string, privilege string"
)
LINEAGE_CHAINS = columns(
    "chain_id string, uc4_workflow string, uc4_job string, source_tables array<string>, staging_table string, "
    "plsql_package string, target_table string, segment_code string, ksh_script string, sqlplus_script string, "
    "abinitio_graph string, spark_job string, cross_repo_source string"
)
DAILY_EVENTS = columns("customer_id bigint, day date, load_date date, event_count bigint, conversion_count bigint")
DAILY_INTERACTIONS = columns("customer_id bigint, day date, load_date date, interaction_count bigint")
CRM_MICRO_SEGMENTS = columns(
    "customer_id bigint, segment_code string, micro_segment string, composite_score double, "
    "churn_risk_score decimal(5,4), clv_score decimal(12,4), engagement_score decimal(9,4), "
    "intervention_recommended string, region_code string"
)

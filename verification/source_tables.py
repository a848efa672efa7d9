"""The given test tables read as the source tables of the weekly jobs.

Every frame is derived by Spark from the whole of a given table. The SQL twin of each rule is in ``oracle.py``.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele import schemas
from clientele.operators.extract import profiles_of

RUN = dt.date(2024, 1, 30)
RUN_SQL = f"DATE '{RUN}'"
DAY_SHIFT = 8217
OWNERS = ("CRM_SCHEMA", "DW_OWNER", "FINANCE_SCHEMA", "OTHER")
PRIVILEGES = ("SELECT", "INSERT", "UPDATE", "DELETE", "REFERENCES")
JOBS = ("signup", "view", "click", "purchase", "error")
REPOSITORIES = {"CRM_SCHEMA": "customer", "DW_OWNER": "retail", "FINANCE_SCHEMA": "finance"}

# Known schemas spare a job per table that would only read file footers.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def pick(number: str, names: tuple[str, ...]) -> str:
    """The name at position ``number`` modulo the count of names."""
    cases = " ".join(f"WHEN {position} THEN '{name}'" for position, name in enumerate(names))
    return f"CASE CAST({number} AS bigint) % {len(names)} {cases} END"


class SourceTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.columns(GIVEN[name])).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customers_by_region(self) -> DataFrame:
        """Customers with their region name."""
        nations = self.given("nation").join(self.given("region"), F.expr("n_regionkey = r_regionkey"))
        return self.given("customer").join(nations, F.expr("c_nationkey = n_nationkey"))

    @cached_property
    def src_customers(self) -> DataFrame:
        return self.customers_by_region.selectExpr(
            "c_custkey AS cust_id",
            "c_name AS cust_ref",
            "c_name AS given_name",
            "CASE WHEN c_custkey % 19 <> 0 THEN concat('F', c_custkey % 100) END AS family_name",
            "CAST(NULL AS date) AS dob",
            "concat(c_name, '@EXAMPLE.COM') AS email",
            "CAST(NULL AS string) AS tel_home",
            "CAST(NULL AS string) AS tel_mobile",
            "CAST(NULL AS string) AS addr_line1",
            "CAST(NULL AS string) AS addr_city",
            "concat('P', c_custkey % 1000) AS addr_postcode",
            "CASE WHEN c_custkey % 5 <> 0 THEN 'GB' END AS country_iso",
            "CASE WHEN c_custkey % 13 <> 0 THEN r_name END AS region_code",
            "CASE WHEN c_custkey % 7 <> 0 THEN 'WEB' END AS acq_channel_code",
            "DATE '2020-01-01' AS created_date",
            "CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS email_opt_in",
            "CAST(NULL AS string) AS sms_opt_in",
            "CASE WHEN c_custkey % 11 = 0 THEN 'N' ELSE 'Y' END AS is_active",
            f"date_sub({RUN_SQL}, CAST(c_custkey % 14 AS int)) AS last_modified_date",
        )

    @cached_property
    def src_customer_segments(self) -> DataFrame:
        return (
            self.given("customer")
            .filter("c_mktsegment <> 'HOUSEHOLD'")
            .selectExpr(
                "c_custkey AS cust_id",
                "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VIP' WHEN 'BUILDING' THEN 'RETAIL' "
                "WHEN 'FURNITURE' THEN 'WHOLESALE' WHEN 'MACHINERY' THEN 'PARTNER' END AS segment_code",
                "'Y' AS is_primary",
                "CASE WHEN c_custkey % 17 = 0 THEN DATE '2023-12-31' ELSE DATE '9999-12-31' END AS valid_to",
            )
        )

    @cached_property
    def src_campaign_events(self) -> DataFrame:
        return self.given("events").selectExpr(
            "event_id",
            "user_id AS cust_id",
            "concat('CAMP', lpad(CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS bigint) % 20, 2, '0')) "
            "AS camp_ref",
            "CASE WHEN event_type = 'signup' THEN 'SENT' WHEN event_type = 'view' THEN 'OPENED' "
            "WHEN event_type = 'click' THEN 'CLICKED' "
            "WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'CONVERTED' "
            "WHEN event_type = 'purchase' THEN 'CLICKED' "
            "WHEN event_type = 'error' THEN 'UNSUBSCRIBED' END AS event_type_cd",
            "ts AS event_dttm",
            "CAST(NULL AS string) AS channel_cd",
            "CAST(NULL AS string) AS offer_code",
            "CAST(value AS decimal(14,4)) AS revenue_attrib",
        )

    @cached_property
    def src_campaigns(self) -> DataFrame:
        """One campaign per group of parts, but for the last group: its events are orphans."""
        return (
            self.given("part")
            .selectExpr("lpad(p_partkey % 20, 2, '0') AS number")
            .filter("number <> '19'")
            .distinct()
            .selectExpr("concat('CAMP', number) AS camp_ref", "concat('Campaign ', number) AS camp_name")
        )

    @cached_property
    def src_interactions(self) -> DataFrame:
        return self.given("events").selectExpr(
            "event_id AS interaction_id",
            "user_id AS cust_id",
            "event_type AS interaction_type_cd",
            "ts AS interaction_date",
            "CAST(NULL AS string) AS channel_cd",
            "CAST(NULL AS bigint) AS agent_id",
            "CAST(NULL AS string) AS resolution_cd",
            "CAST(1 + (event_id % 91) / 10 AS decimal(3,1)) AS csat_score",
            "event_id % 60 AS duration_mins",
        )

    @cached_property
    def priced_orders(self) -> DataFrame:
        """Orders with an exact price and a date that ends at the run date."""
        return self.given("orders").selectExpr(
            "o_custkey",
            "CAST(o_totalprice AS decimal(14,2)) AS price",
            f"date_add(CAST(o_orderdate AS date), {DAY_SHIFT}) AS day",
        )

    @cached_property
    def stg_customer_sales(self) -> DataFrame:
        per_customer = (
            self.priced_orders.filter("o_custkey % 10 <> 7")
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(
                F.expr("CAST(sum(price) * 100 AS bigint) AS cents"),
                F.expr("max(day) AS last_purchase_date"),
            )
        )
        regions = self.customers_by_region.selectExpr("c_custkey AS customer_id", "r_name")
        return per_customer.join(regions, "customer_id", "left").selectExpr(
            "customer_id",
            "CAST(CAST(cents div (CASE customer_id % 4 WHEN 0 THEN 400 WHEN 1 THEN 1500 WHEN 2 THEN 4000 "
            "ELSE 20000 END) AS decimal(16,0)) * 0.01 AS decimal(14,2)) AS lifetime_value",
            "CASE WHEN customer_id % 3 <> 0 THEN 'GOLD' END AS loyalty_tier",
            "last_purchase_date",
            "r_name AS region_code",
            f"date_sub({RUN_SQL}, CAST(customer_id % 14 AS int)) AS load_date",
        )

    @cached_property
    def fact_regional_summary(self) -> DataFrame:
        regions = self.customers_by_region.select("c_custkey", "r_name")
        return (
            self.priced_orders.join(regions, F.expr("o_custkey = c_custkey"))
            .groupBy(F.expr("r_name AS region_code"), F.expr("day AS summary_date"))
            .agg(
                F.expr("CAST(sum(price) AS decimal(18,4)) AS total_revenue"),
                F.expr("count(DISTINCT o_custkey) AS distinct_customers"),
                F.expr(
                    "CAST(round(sum(price) / CAST(count(price) AS decimal(18,0)), 4) AS decimal(14,4)) "
                    "AS avg_basket_size"
                ),
            )
        )

    @cached_property
    def dim_customer_crm(self) -> DataFrame:
        """The dimension before the run: most customers, some with an older version, some differing from staging."""
        older = "(customer_id % 8 = 1 AND version_num = 1)"
        known = profiles_of(self.src_customers, self.src_customer_segments, RUN).filter("customer_id % 5 <> 4")
        return known.selectExpr(
            "*", "explode(CASE WHEN customer_id % 8 = 1 THEN array(1, 2) ELSE array(1) END) AS version_num"
        ).selectExpr(
            "1000 + customer_id * 2 + version_num - 1 AS dim_crm_customer_key",
            "customer_id",
            "customer_code",
            "concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name",
            f"CASE WHEN {older} OR customer_id % 6 = 1 THEN concat('old.', email) ELSE email END AS email",
            "phone",
            "date_of_birth",
            "CASE WHEN customer_id % 9 <> 2 THEN postcode END AS postcode",
            "region_code",
            "customer_segment",
            "acquisition_channel",
            "is_opted_in_email",
            "CASE WHEN version_num = 2 THEN DATE '2023-07-01' ELSE DATE '2023-01-01' END AS valid_from",
            f"CASE WHEN {older} THEN DATE '2023-06-30' ELSE DATE '9999-12-31' END AS valid_to",
            f"CASE WHEN {older} THEN 'N' ELSE 'Y' END AS is_current",
            "version_num",
            "CASE WHEN version_num = 2 THEN DATE '2023-07-01' ELSE DATE '2023-01-01' END AS created_date",
            f"CASE WHEN {older} THEN DATE '2023-07-01' END AS updated_date",
        )

    @cached_property
    def scoring_feature_config(self) -> DataFrame:
        """Configuration rows: of two models and several segments, one of them switched off."""
        rows = [
            ("spend", "coalesce(lifetime_value, 0)", 0.5, "DW_OWNER.STG_CUSTOMER_SALES", 365, "v3", "ALL", "Y", 2),
            ("convs", "conversion_count", 0.25, "STG_CAMPAIGN_EVENTS", 20, "v3", "ALL", "Y", 1),
            ("contacts", "interaction_count * 10", 0.25, "STG_CUSTOMER_INTERACTIONS", 10, "v3", "VIP", "Y", 3),
            ("contacts_retail", "interaction_count", 0.25, "STG_CUSTOMER_INTERACTIONS", 60, "v3", "RETAIL", "Y", 3),
            ("off", "1", 1.0, None, 5, "v3", "ALL", "N", 4),
            ("other_model", "1", 1.0, "STG_CAMPAIGN_EVENTS", 60, "v2.1", "ALL", "Y", 1),
        ]
        return self.spark.createDataFrame(rows, schemas.SCORING_FEATURE_CONFIG)

    @cached_property
    def audit_messages(self) -> DataFrame:
        return self.given("events").selectExpr(
            "concat('WF_', user_id % 30) AS workflow_name",
            "event_type AS job_name",
            "CAST(ts AS date) AS run_date",
            "CASE event_id % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'NO_DATA' WHEN 2 THEN 'RUNNING' "
            "ELSE 'SUCCESS' END AS status",
            "event_id AS rows_processed",
            "ts AS message_ts",
        )

    @cached_property
    def asked_jobs(self) -> DataFrame:
        """One prerequisite per customer; some workflows and dates have no audit row."""
        return self.given("customer").selectExpr(
            "c_custkey AS request_id",
            "concat('WF_', c_custkey % 35) AS workflow_name",
            f"{pick('c_custkey', JOBS)} AS job_name",
            f"date_sub({RUN_SQL}, CAST(c_custkey % 33 AS int)) AS run_date",
        )

    @cached_property
    def dependency_edges(self) -> DataFrame:
        return self.given("lineitem").selectExpr(
            f"{pick('l_suppkey', OWNERS)} AS object_owner",
            "concat('PKG_', l_suppkey % 40) AS object_name",
            "CASE l_returnflag WHEN 'A' THEN 'PACKAGE BODY' WHEN 'N' THEN 'PROCEDURE' ELSE 'VIEW' END AS object_type",
            f"{pick('l_partkey', OWNERS)} AS ref_owner",
            "concat('TAB_', l_partkey % 200) AS ref_name",
            "'TABLE' AS ref_type",
        )

    @cached_property
    def grants(self) -> DataFrame:
        return (
            self.given("lineitem")
            .selectExpr(
                f"{pick('l_suppkey', OWNERS)} AS source_schema",
                "concat('TAB_', l_partkey % 200) AS source_table",
                f"{pick('l_linenumber', OWNERS)} AS target_schema",
                f"{pick('l_quantity', PRIVILEGES)} AS privilege",
            )
            .distinct()
        )

    @cached_property
    def lineage_chains(self) -> DataFrame:
        """One chain per supplier; every third has no package, some packages have no edges."""
        package = f"concat({pick('s_suppkey', OWNERS)}, '.PKG_', s_suppkey % 45, '.LOAD_', s_suppkey)"
        return self.given("supplier").selectExpr(
            "concat('CHAIN-', s_suppkey) AS chain_id",
            "'WEEKLY' AS uc4_workflow",
            "concat('JOB_', s_suppkey) AS uc4_job",
            "array(concat('SRC.T_', s_suppkey), 'SRC.COMMON') AS source_tables",
            "CASE WHEN s_suppkey % 2 = 0 THEN concat('STG.T_', s_suppkey) END AS staging_table",
            f"CASE WHEN s_suppkey % 3 <> 0 THEN {package} END AS plsql_package",
            "concat('DW.T_', s_suppkey) AS target_table",
            "CASE WHEN s_suppkey % 5 = 0 THEN 'VIP' END AS segment_code",
            "concat('load_', s_suppkey % 7, '.ksh') AS ksh_script",
            "CASE WHEN s_suppkey % 2 = 0 THEN concat('extract_', s_suppkey % 7, '.sql') END AS sqlplus_script",
            "CASE WHEN s_suppkey % 4 = 1 THEN concat('graph_', s_suppkey % 7) END AS abinitio_graph",
            "CASE WHEN s_suppkey % 4 = 3 THEN concat('job_', s_suppkey % 7) END AS spark_job",
            "CASE WHEN s_suppkey % 6 = 0 THEN 'retail' END AS cross_repo_source",
        )

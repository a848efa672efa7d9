"""The queries in plain SQL, written apart from the library, over the same given tables.

``TABLES`` holds named subqueries; a query lists only its last step and gets the subqueries it mentions, directly or
through others. Money and rates are rounded with whole-number arithmetic, so no rounding tie depends on the engine.
"""

from __future__ import annotations

import re

RUN = "DATE '2024-01-30'"


def rounded(part: str, whole: str, places: int) -> str:
    """part / whole of whole numbers, half away from zero, as a decimal with ``places`` digits."""
    unit = "0." + "0" * (places - 1) + "1"
    top = f"CAST(2 * 10**{places} AS HUGEINT) * CAST({part} AS HUGEINT) + CAST({whole} AS HUGEINT)"
    bottom = f"CAST(2 AS HUGEINT) * CAST({whole} AS HUGEINT)"
    return f"CASE WHEN {whole} > 0 THEN CAST(({top}) // ({bottom}) AS DECIMAL(18,0)) * {unit} END"


def units(column: str) -> str:
    """A decimal with four places as a whole number of ten-thousandths."""
    return f"CAST({column} * 10000 AS BIGINT)"


def choose(number: str, names: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE CAST({number} AS BIGINT) % {len(names)} {cases} END"


OWNERS = ("CRM_SCHEMA", "DW_OWNER", "FINANCE_SCHEMA", "OTHER")
PRIVILEGES = ("SELECT", "INSERT", "UPDATE", "DELETE", "REFERENCES")
JOBS = ("signup", "view", "click", "purchase", "error")
THREE = "('CRM_SCHEMA', 'DW_OWNER', 'FINANCE_SCHEMA')"

CHURN = f"""CAST(CASE
    WHEN last_purchase_date IS NULL THEN 0.95
    WHEN {RUN} - last_purchase_date > 180 THEN 0.80
    WHEN {RUN} - last_purchase_date > 90 THEN 0.50
    WHEN {RUN} - last_purchase_date > 30 THEN 0.20
    ELSE 0.05 END AS DECIMAL(5,4))"""
THOUSANDS = "CAST(COALESCE(lifetime_value, 0) AS DECIMAL(14,2)) * 0.001"
SHORT = """CASE customer_segment WHEN 'VIP' THEN 'High-Value Premium' WHEN 'RETAIL' THEN 'Standard Retail'
    WHEN 'WHOLESALE' THEN 'B2B Wholesale' ELSE 'Unclassified' END"""
LONG = """CASE customer_segment WHEN 'VIP' THEN 'High-Value Premium Customer'
    WHEN 'RETAIL' THEN 'Standard Retail Customer' WHEN 'WHOLESALE' THEN 'B2B Wholesale Customer'
    ELSE 'Unclassified' END"""
CHANGED = """(o.full_name IS DISTINCT FROM n.full_name OR o.email IS DISTINCT FROM n.email
    OR o.postcode IS DISTINCT FROM n.postcode OR o.customer_segment IS DISTINCT FROM n.customer_segment
    OR o.is_opted_in_email IS DISTINCT FROM n.is_opted_in_email)"""
DIM = """dim_crm_customer_key, customer_id, customer_code, full_name, email, phone, date_of_birth, postcode,
    region_code, customer_segment, acquisition_channel, is_opted_in_email, valid_from, valid_to, is_current,
    version_num, created_date, updated_date"""


def score_rows(source: str, variant: str, model: str = "v2.1") -> str:
    """Fact rows from a base of customers with figures."""
    if variant == "procedural":
        clv, label, batch = f"round({THOUSANDS}, 4)", SHORT, "1"
        engagement = "COALESCE(interact_score, 0)"
    else:
        clv, label, batch = f"round(least({THOUSANDS}, 10.0), 4)", LONG, "20240130"
        engagement = """CASE WHEN COALESCE(interaction_count, 0) > 10 THEN 1.0
            WHEN COALESCE(interaction_count, 0) > 5 THEN 0.75
            WHEN COALESCE(interaction_count, 0) > 0 THEN 0.25 ELSE 0.0 END"""
    return f"""
        SELECT customer_id, dim_crm_customer_key, {RUN} AS score_date,
               CAST({clv} AS DECIMAL(12,4)) AS clv_score,
               {CHURN} AS churn_risk_score,
               CAST(COALESCE(conversion_rate, 0) AS DECIMAL(5,4)) AS propensity_buy_score,
               CAST({engagement} AS DECIMAL(9,4)) AS engagement_score,
               customer_segment AS segment_code, {label} AS segment_label, {RUN} AS batch_run_date,
               '{model}' AS model_version, CAST({batch} AS BIGINT) AS load_batch_id
        FROM {source}"""


def score_base(dimension: str) -> str:
    return f"""
        SELECT d.customer_id, d.dim_crm_customer_key, d.customer_segment, d.region_code,
               s.lifetime_value, s.last_purchase_date, r.conversion_rate, r.conversion_count,
               i.interaction_count, i.interact_score
        FROM {dimension} d
        LEFT JOIN stg_sales s ON s.customer_id = d.customer_id
        LEFT JOIN rates r ON r.customer_id = d.customer_id
        LEFT JOIN contacts i ON i.customer_id = d.customer_id
        WHERE d.is_current = 'Y'"""


def segmented(scores: str, dimension: str) -> str:
    return f"""
        SELECT f.customer_id, f.dim_crm_customer_key, f.clv_score, f.churn_risk_score, f.propensity_buy_score,
               f.engagement_score, f.segment_code, f.segment_label, d.region_code, d.acquisition_channel,
               d.is_opted_in_email, s.lifetime_value, s.loyalty_tier, s.last_purchase_date,
               g.total_revenue, g.avg_basket_size,
               f.clv_score * 0.30 + (1 - f.churn_risk_score) * 0.25 + f.engagement_score * 0.20
                   + f.propensity_buy_score * 0.15
                   + least(COALESCE(s.lifetime_value, 0) * 0.0001, 1) * 0.10 AS composite_score
        FROM {scores} f
        JOIN {dimension} d ON d.customer_id = f.customer_id AND d.is_current = 'Y'
        LEFT JOIN stg_sales s ON s.customer_id = f.customer_id
        LEFT JOIN regional g ON g.region_code = d.region_code AND g.summary_date = {RUN}"""


def classified(source: str) -> str:
    return f"""
        SELECT *,
               CASE WHEN composite_score >= 0.8 THEN 'CHAMPION' WHEN composite_score >= 0.6 THEN 'LOYAL_CUSTOMER'
                    WHEN composite_score >= 0.4 THEN 'POTENTIAL_LOYALIST' WHEN composite_score >= 0.2 THEN 'AT_RISK'
                    ELSE 'LOST_CUSTOMER' END AS micro_segment,
               CASE WHEN churn_risk_score > 0.7 AND composite_score >= 0.4 THEN 'WINBACK_CAMPAIGN'
                    WHEN churn_risk_score > 0.5 AND engagement_score < 0.3 THEN 'REENGAGEMENT_CAMPAIGN'
                    WHEN clv_score > 7.0 AND is_opted_in_email = 'Y' THEN 'VIP_UPGRADE'
                    ELSE 'NO_ACTION' END AS intervention_recommended
        FROM {source}"""


def summary(scores: str, region: str, times: str, where: str = "TRUE") -> str:
    """Segment summary straight from joined rows: revenue repeated per row, or taken once per region."""
    if times == "once":
        spend = f"""COALESCE((SELECT sum(x.total_revenue) FROM regional x WHERE x.summary_date = {RUN}
            AND x.region_code = any_value(d.region_code)), 0)"""
    else:
        spend = "COALESCE(sum(g.total_revenue), 0)"
    return f"""
        SELECT f.segment_code, {region} AS region_code, {RUN} AS summary_date,
               count(DISTINCT f.customer_id) AS customer_count,
               {rounded(f"sum({units('f.clv_score')})", "(count(f.clv_score) * 10000)", 4)} AS avg_clv_score,
               {rounded(f"sum({units('f.churn_risk_score')})", "(count(f.churn_risk_score) * 10000)", 6)}
                   AS avg_churn_risk,
               count(*) FILTER (WHERE f.clv_score > 5) AS high_value_count,
               count(*) FILTER (WHERE f.churn_risk_score > 0.7) AS at_risk_count,
               {spend} AS total_retail_spend
        FROM {scores} f
        JOIN dim d ON d.customer_id = f.customer_id AND d.is_current = 'Y'
        LEFT JOIN regional g ON g.region_code = d.region_code AND g.summary_date = {RUN}
        WHERE f.score_date = {RUN} AND {where}
        GROUP BY f.segment_code, {region}"""


TABLES: dict[str, str] = {
    "homes": """
        SELECT c.*, r.r_name FROM customer c
        JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "segment_rows": """
        SELECT c_custkey AS cust_id,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VIP' WHEN 'BUILDING' THEN 'RETAIL'
                    WHEN 'FURNITURE' THEN 'WHOLESALE' WHEN 'MACHINERY' THEN 'PARTNER' END AS segment_code,
               CASE WHEN c_custkey % 17 = 0 THEN DATE '2023-12-31' ELSE DATE '9999-12-31' END AS valid_to
        FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "people": f"""
        SELECT h.c_custkey AS customer_id, h.c_name AS customer_code, h.c_name AS first_name,
               CASE WHEN h.c_custkey % 19 <> 0 THEN 'F' || (h.c_custkey % 100) END AS last_name,
               CAST(NULL AS DATE) AS date_of_birth, lower(h.c_name || '@EXAMPLE.COM') AS email,
               CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS mobile,
               CAST(NULL AS VARCHAR) AS address_line1, CAST(NULL AS VARCHAR) AS address_line2,
               CAST(NULL AS VARCHAR) AS city, 'P' || (h.c_custkey % 1000) AS postcode, 'GB' AS country_code,
               CASE WHEN h.c_custkey % 13 <> 0 THEN h.r_name END AS region_code,
               COALESCE(s.segment_code, 'RETAIL') AS customer_segment,
               CASE WHEN h.c_custkey % 7 = 0 THEN 'UNKNOWN' ELSE 'WEB' END AS acquisition_channel,
               DATE '2020-01-01' AS registration_date,
               CASE WHEN h.c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS is_opted_in_email, 'N' AS is_opted_in_sms,
               {RUN} AS load_date, 'PENDING' AS etl_status
        FROM homes h LEFT JOIN segment_rows s ON s.cust_id = h.c_custkey AND s.valid_to >= {RUN}""",
    "staged": "SELECT * FROM people WHERE customer_id % 11 <> 0 AND customer_id % 14 <= 7",
    "source_events": """
        SELECT event_id, user_id AS customer_id,
               'CAMP' || lpad(CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 20 AS VARCHAR), 2, '0') AS campaign_id,
               CASE WHEN event_type = 'signup' THEN 'SENT' WHEN event_type = 'view' THEN 'OPENED'
                    WHEN event_type = 'click' THEN 'CLICKED'
                    WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'CONVERTED'
                    WHEN event_type = 'purchase' THEN 'CLICKED' WHEN event_type = 'error' THEN 'UNSUBSCRIBED'
               END AS event_type,
               ts AS event_date, CAST(value AS DECIMAL(14,4)) AS revenue_attributed
        FROM events""",
    "campaign_rows": """
        SELECT DISTINCT 'CAMP' || lpad(CAST(p_partkey % 20 AS VARCHAR), 2, '0') AS campaign_id,
               'Campaign ' || lpad(CAST(p_partkey % 20 AS VARCHAR), 2, '0') AS campaign_name
        FROM part WHERE p_partkey % 20 <> 19""",
    "stg_events": f"""
        SELECT event_id, customer_id, campaign_id, c.campaign_name,
               event_type, event_date, CAST(NULL AS VARCHAR) AS channel, CAST(NULL AS VARCHAR) AS offer_code,
               COALESCE(revenue_attributed, 0) AS revenue_attributed, {RUN} AS load_date
        FROM source_events JOIN campaign_rows c USING (campaign_id)
        WHERE event_date >= {RUN} - 90 AND event_date < {RUN} + 1
          AND customer_id IN (SELECT customer_id FROM staged)""",
    "stg_interactions": f"""
        SELECT event_id AS interaction_id, user_id AS customer_id, event_type AS interaction_type,
               ts AS interaction_date, CAST(NULL AS VARCHAR) AS channel, CAST(NULL AS BIGINT) AS agent_id,
               CAST(NULL AS VARCHAR) AS resolution_code,
               CAST(1 + CAST(event_id % 91 AS DECIMAL(5,0)) * 0.1 AS DECIMAL(3,1)) AS satisfaction_score,
               event_id % 60 AS duration_minutes, CAST(NULL AS VARCHAR) AS notes, {RUN} AS load_date
        FROM events
        WHERE ts >= {RUN} - 30 AND ts < {RUN} + 1
          AND user_id IN (SELECT customer_id FROM staged)""",
    "staged_before": "SELECT * FROM people WHERE customer_id % 11 <> 0",
    "events_of_two": f"""
        SELECT event_id, customer_id, event_type FROM source_events JOIN campaign_rows USING (campaign_id)
        WHERE event_date >= {RUN} - 97 AND event_date < {RUN} - 6
          AND customer_id IN (SELECT customer_id FROM staged_before)
        UNION SELECT event_id, customer_id, event_type FROM stg_events""",
    "interactions_of_two": f"""
        SELECT event_id, user_id AS customer_id FROM events
        WHERE ts >= {RUN} - 37 AND ts < {RUN} - 6 AND user_id IN (SELECT customer_id FROM staged_before)
        UNION SELECT interaction_id, customer_id FROM stg_interactions""",
    "priced": """
        SELECT o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS price, CAST(o_orderdate AS DATE) + 8217 AS day
        FROM orders""",
    "stg_sales": f"""
        SELECT p.o_custkey AS customer_id,
               CAST(CAST(CAST(sum(p.price) * 100 AS BIGINT)
                    // (CASE p.o_custkey % 4 WHEN 0 THEN 400 WHEN 1 THEN 1500 WHEN 2 THEN 4000 ELSE 20000 END)
                    AS DECIMAL(14,0)) * 0.01 AS DECIMAL(14,2)) AS lifetime_value,
               CASE WHEN p.o_custkey % 3 <> 0 THEN 'GOLD' END AS loyalty_tier,
               max(p.day) AS last_purchase_date, any_value(h.r_name) AS region_code,
               {RUN} - CAST(p.o_custkey % 14 AS INTEGER) AS load_date
        FROM priced p LEFT JOIN homes h ON h.c_custkey = p.o_custkey
        WHERE p.o_custkey % 10 <> 7 GROUP BY p.o_custkey""",
    "recent_sales": f"SELECT * FROM stg_sales WHERE load_date >= {RUN} - 7",
    "regional": f"""
        SELECT h.r_name AS region_code, p.day AS summary_date,
               CAST(sum(p.price) AS DECIMAL(18,4)) AS total_revenue,
               count(DISTINCT p.o_custkey) AS distinct_customers,
               {rounded("CAST(sum(p.price) * 100 AS BIGINT)", "(count(*) * 100)", 4)} AS avg_basket_size
        FROM priced p JOIN homes h ON h.c_custkey = p.o_custkey GROUP BY h.r_name, p.day""",
    "dim": """
        SELECT 1000 + customer_id * 2 + v.version_num - 1 AS dim_crm_customer_key, customer_id, customer_code,
               COALESCE(first_name, '') || ' ' || COALESCE(last_name, '') AS full_name,
               CASE WHEN (customer_id % 8 = 1 AND v.version_num = 1) OR customer_id % 6 = 1
                    THEN 'old.' || email ELSE email END AS email,
               phone, date_of_birth, CASE WHEN customer_id % 9 <> 2 THEN postcode END AS postcode, region_code,
               customer_segment, acquisition_channel, is_opted_in_email,
               CASE WHEN v.version_num = 2 THEN DATE '2023-07-01' ELSE DATE '2023-01-01' END AS valid_from,
               CASE WHEN customer_id % 8 = 1 AND v.version_num = 1 THEN DATE '2023-06-30'
                    ELSE DATE '9999-12-31' END AS valid_to,
               CASE WHEN customer_id % 8 = 1 AND v.version_num = 1 THEN 'N' ELSE 'Y' END AS is_current,
               CAST(v.version_num AS INTEGER) AS version_num,
               CASE WHEN v.version_num = 2 THEN DATE '2023-07-01' ELSE DATE '2023-01-01' END AS created_date,
               CASE WHEN customer_id % 8 = 1 AND v.version_num = 1 THEN DATE '2023-07-01' END AS updated_date
        FROM people JOIN (VALUES (1), (2)) v(version_num) ON v.version_num = 1 OR customer_id % 8 = 1
        WHERE customer_id % 5 <> 4""",
    "arriving": "SELECT *, COALESCE(first_name, '') || ' ' || COALESCE(last_name, '') AS full_name FROM staged",
    "to_close": f"""
        SELECT o.* FROM dim o JOIN arriving n ON n.customer_id = o.customer_id
        WHERE o.is_current = 'Y' AND {CHANGED}""",
    "closed": f"""
        SELECT * REPLACE ({RUN} - 1 AS valid_to, 'N' AS is_current, {RUN} AS updated_date) FROM to_close""",
    "inserted": f"""
        SELECT (SELECT max(dim_crm_customer_key) + 1 FROM dim)
               + row_number() OVER (ORDER BY n.customer_id) - 1 AS dim_crm_customer_key,
               n.customer_id, n.customer_code, n.full_name, n.email, n.phone, n.date_of_birth, n.postcode,
               n.region_code, n.customer_segment, n.acquisition_channel, n.is_opted_in_email,
               {RUN} AS valid_from, DATE '9999-12-31' AS valid_to, 'Y' AS is_current,
               CAST(COALESCE((SELECT max(d.version_num) FROM dim d WHERE d.customer_id = n.customer_id), 0) + 1
                    AS INTEGER) AS version_num,
               {RUN} AS created_date, CAST(NULL AS DATE) AS updated_date
        FROM arriving n
        WHERE n.customer_id NOT IN (SELECT customer_id FROM dim WHERE is_current = 'Y')
           OR n.customer_id IN (SELECT customer_id FROM to_close)""",
    "merged": f"""
        SELECT {DIM} FROM dim
        WHERE dim_crm_customer_key NOT IN (SELECT dim_crm_customer_key FROM to_close)
        UNION ALL SELECT {DIM} FROM closed UNION ALL SELECT {DIM} FROM inserted""",
    "rates": f"""
        SELECT customer_id, count(*) AS event_count,
               count(*) FILTER (WHERE event_type = 'CONVERTED') AS conversion_count,
               {rounded("count(*) FILTER (WHERE event_type = 'CONVERTED')", "count(*)", 4)} AS conversion_rate
        FROM stg_events WHERE event_date >= {RUN} - 90 GROUP BY customer_id""",
    "contacts": f"""
        SELECT customer_id, count(*) AS interaction_count, {rounded("count(*)", "30", 4)} AS interact_score
        FROM stg_interactions WHERE interaction_date >= {RUN} - 30 GROUP BY customer_id""",
    "rollup_by_customer": """
        SELECT customer_id, count(*) FILTER (WHERE event_type = 'CONVERTED') AS campaign_conversions,
               CAST(sum(revenue_attributed) AS DECIMAL(18,4)) AS total_campaign_revenue
        FROM stg_events GROUP BY customer_id""",
    "base": score_base("dim"),
    "procedural": score_rows("base", "procedural"),
    "configured": score_rows("base", "configured"),
    "graph": f"""
        SELECT t.customer_id, t.customer_code, t.full_name, t.email, t.region_code, t.customer_segment,
               t.acquisition_channel, t.is_opted_in_email,
               COALESCE(s.lifetime_value, CAST(0 AS DECIMAL(14,2))) AS lifetime_value,
               COALESCE(s.loyalty_tier, 'STANDARD') AS loyalty_tier, s.last_purchase_date,
               COALESCE(c.campaign_conversions, 0) AS campaign_conversions,
               COALESCE(c.total_campaign_revenue, 0) AS total_campaign_revenue,
               COALESCE({RUN} - s.last_purchase_date, 999) AS days_since_purchase,
               CAST(round({THOUSANDS}, 4) AS DECIMAL(12,4)) AS clv_score,
               {CHURN} AS churn_risk_score,
               CAST(CASE WHEN COALESCE(c.campaign_conversions, 0) > 10 THEN 1.0
                         WHEN COALESCE(c.campaign_conversions, 0) > 5 THEN 0.75
                         WHEN COALESCE(c.campaign_conversions, 0) > 1 THEN 0.50
                         WHEN COALESCE(c.campaign_conversions, 0) > 0 THEN 0.25
                         ELSE 0.0 END AS DECIMAL(5,4)) AS engagement_score,
               {LONG} AS segment_label
        FROM arriving t
        LEFT JOIN recent_sales s ON s.customer_id = t.customer_id
        LEFT JOIN rollup_by_customer c ON c.customer_id = t.customer_id""",
    "scored_customers": segmented("configured", "dim"),
    "segmented": classified("scored_customers"),
    "merged_base": score_base("merged"),
    "merged_scores": score_rows("merged_base", "configured"),
    "merged_customers": segmented("merged_scores", "merged"),
    "merged_segmented": classified("merged_customers"),
    "messages": """
        SELECT 'WF_' || (user_id % 30) AS workflow_name, event_type AS job_name, CAST(ts AS DATE) AS run_date,
               CASE event_id % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'NO_DATA' WHEN 2 THEN 'RUNNING'
                    ELSE 'SUCCESS' END AS status,
               event_id AS rows_processed, ts AS message_ts
        FROM events""",
    "ranked_messages": """
        SELECT *, row_number() OVER (PARTITION BY workflow_name, job_name, run_date
                                     ORDER BY message_ts DESC, rows_processed DESC) AS place,
               min(message_ts) OVER (PARTITION BY workflow_name, job_name, run_date) AS created_date,
               count(*) OVER (PARTITION BY workflow_name, job_name, run_date) AS message_count
        FROM messages""",
    "audit": """
        SELECT workflow_name, job_name, run_date, status, rows_processed, created_date,
               CASE WHEN message_count > 1 THEN message_ts END AS updated_date
        FROM ranked_messages WHERE place = 1""",
    "asked": f"""
        SELECT c_custkey AS request_id, 'WF_' || (c_custkey % 35) AS workflow_name,
               {choose("c_custkey", JOBS)} AS job_name, {RUN} - CAST(c_custkey % 33 AS INTEGER) AS run_date
        FROM customer""",
    "edges": f"""
        SELECT {choose("l_suppkey", OWNERS)} || '.PKG_' || (l_suppkey % 40) AS object_name,
               {choose("l_suppkey", OWNERS)} AS object_owner,
               CASE l_returnflag WHEN 'A' THEN 'PACKAGE BODY' WHEN 'N' THEN 'PROCEDURE' ELSE 'VIEW' END AS object_type,
               {choose("l_partkey", OWNERS)} AS ref_owner,
               {choose("l_partkey", OWNERS)} || '.TAB_' || (l_partkey % 200) AS table_ref
        FROM lineitem""",
    "mapped": f"""
        SELECT object_name, table_ref, count(*) AS edge_count FROM edges
        WHERE object_owner IN {THREE} AND ref_owner IN {THREE} AND object_type IN ('PACKAGE BODY', 'PROCEDURE')
        GROUP BY object_name, table_ref""",
    "paged": """
        SELECT object_name, table_ref, edge_count, count(*) OVER (PARTITION BY object_name) AS table_count,
               CAST(CAST('0x' || substr(md5(table_ref), 1, 8) AS BIGINT)
                    % ((count(*) OVER (PARTITION BY object_name) + 199) // 200) AS INTEGER) AS page
        FROM mapped""",
    "lists": """
        SELECT object_name, page, list(table_ref ORDER BY table_ref) AS table_refs,
               list(edge_count ORDER BY table_ref) AS edge_counts,
               CAST(sum(edge_count) AS BIGINT) AS edge_count, max(table_count) AS table_count
        FROM paged GROUP BY object_name, page""",
    "grant_rows": f"""
        SELECT DISTINCT {choose("l_suppkey", OWNERS)} AS source_schema, 'TAB_' || (l_partkey % 200) AS source_table,
               {choose("l_linenumber", OWNERS)} AS target_schema, {choose("l_quantity", PRIVILEGES)} AS privilege
        FROM lineitem""",
    "links": f"""
        SELECT CASE source_schema WHEN 'CRM_SCHEMA' THEN 'customer' WHEN 'DW_OWNER' THEN 'retail'
                    WHEN 'FINANCE_SCHEMA' THEN 'finance' ELSE 'unknown' END AS source_repo,
               source_schema, source_table,
               CASE target_schema WHEN 'CRM_SCHEMA' THEN 'customer' WHEN 'DW_OWNER' THEN 'retail'
                    WHEN 'FINANCE_SCHEMA' THEN 'finance' ELSE 'unknown' END AS target_repo,
               target_schema, privilege AS access_type, 'CROSS_REPO_GRANT' AS link_type
        FROM grant_rows
        WHERE source_schema IN {THREE} AND target_schema IN {THREE} AND source_schema <> target_schema
          AND privilege <> 'REFERENCES'""",
    "chains": f"""
        SELECT 'CHAIN-' || s_suppkey AS chain_id, 'WEEKLY' AS uc4_workflow, 'JOB_' || s_suppkey AS uc4_job,
               ['SRC.T_' || s_suppkey, 'SRC.COMMON'] AS source_tables,
               CASE WHEN s_suppkey % 2 = 0 THEN 'STG.T_' || s_suppkey END AS staging_table,
               CASE WHEN s_suppkey % 3 <> 0 THEN {choose("s_suppkey", OWNERS)} || '.PKG_' || (s_suppkey % 45)
                    || '.LOAD_' || s_suppkey END AS plsql_package,
               'DW.T_' || s_suppkey AS target_table, CASE WHEN s_suppkey % 5 = 0 THEN 'VIP' END AS segment_code,
               'load_' || (s_suppkey % 7) || '.ksh' AS ksh_script,
               CASE WHEN s_suppkey % 2 = 0 THEN 'extract_' || (s_suppkey % 7) || '.sql' END AS sqlplus_script,
               CASE WHEN s_suppkey % 4 = 1 THEN 'graph_' || (s_suppkey % 7) END AS abinitio_graph,
               CASE WHEN s_suppkey % 4 = 3 THEN 'job_' || (s_suppkey % 7) END AS spark_job,
               CASE WHEN s_suppkey % 6 = 0 THEN 'retail' END AS cross_repo_source
        FROM supplier""",
    "chain_lists": """
        SELECT c.*, COALESCE(l.page, 0) AS page,
               CASE WHEN c.plsql_package IS NOT NULL
                    THEN COALESCE(l.table_refs, CAST([] AS VARCHAR[])) END AS plsql_table_refs,
               CASE WHEN c.plsql_package IS NOT NULL THEN l.table_refs IS NOT NULL END AS has_table_refs
        FROM chains c
        LEFT JOIN lists l
          ON l.object_name = split_part(c.plsql_package, '.', 1) || '.' || split_part(c.plsql_package, '.', 2)""",
}

SCORES = """customer_id, dim_crm_customer_key, score_date, CAST(clv_score AS DOUBLE) AS clv_score,
    CAST(churn_risk_score AS DOUBLE) AS churn_risk_score,
    CAST(propensity_buy_score AS DOUBLE) AS propensity_buy_score,
    CAST(engagement_score AS DOUBLE) AS engagement_score, segment_code, segment_label, batch_run_date,
    model_version, load_batch_id"""
SUMMARY = """segment_code, region_code, summary_date, customer_count, CAST(avg_clv_score AS DOUBLE) AS avg_clv_score,
    CAST(avg_churn_risk AS DOUBLE) AS avg_churn_risk, high_value_count, at_risk_count,
    CAST(total_retail_spend AS DOUBLE) AS total_retail_spend"""
GRAPH = """customer_id, customer_code, full_name, email, region_code, customer_segment, acquisition_channel,
    is_opted_in_email, CAST(lifetime_value AS DOUBLE) AS lifetime_value, loyalty_tier, last_purchase_date,
    campaign_conversions, CAST(total_campaign_revenue AS DOUBLE) AS total_campaign_revenue,
    CAST(days_since_purchase AS INTEGER) AS days_since_purchase, CAST(clv_score AS DOUBLE) AS clv_score,
    CAST(churn_risk_score AS DOUBLE) AS churn_risk_score, CAST(engagement_score AS DOUBLE) AS engagement_score,
    segment_label"""
MICRO = """customer_id, segment_code, micro_segment, CAST(composite_score AS DOUBLE) AS composite_score,
    CAST(churn_risk_score AS DOUBLE) AS churn_risk_score, CAST(clv_score AS DOUBLE) AS clv_score,
    CAST(engagement_score AS DOUBLE) AS engagement_score, intervention_recommended, region_code"""
SALES = """customer_id, CAST(lifetime_value AS DOUBLE) AS lifetime_value, loyalty_tier, last_purchase_date"""
REGIONAL = """region_code, summary_date, CAST(total_revenue AS DOUBLE) AS total_revenue, distinct_customers,
    CAST(avg_basket_size AS DOUBLE) AS avg_basket_size"""


def performance(where: str) -> str:
    def count(kind: str) -> str:
        return f"count(*) FILTER (WHERE event_type = '{kind}')"

    def rate(part: str, whole: str) -> str:
        return f"CAST({rounded(count(part), count(whole), 6)} AS DOUBLE)"

    return f"""
        SELECT campaign_id, CAST(event_date AS DATE) AS performance_date, {count('SENT')} AS total_sent,
               {count('OPENED')} AS total_opened, {count('CLICKED')} AS total_clicked,
               {count('CONVERTED')} AS total_converted, {count('UNSUBSCRIBED')} AS total_unsubscribed,
               CAST(sum(revenue_attributed) AS DOUBLE) AS revenue_attributed,
               {rate('OPENED', 'SENT')} AS open_rate, {rate('CLICKED', 'OPENED')} AS click_rate,
               {rate('CONVERTED', 'SENT')} AS conversion_rate
        FROM stg_events WHERE {where} GROUP BY campaign_id, CAST(event_date AS DATE)"""


def average(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def feature(weight: str, value: str) -> str:
    return f"CAST({weight} AS DOUBLE) * CASE WHEN {value} IS NULL THEN 0 ELSE least({value} / 1000, 1) END"


def feature_query(source: str, parts: list[tuple[str, str, str]]) -> str:
    double = [(name, f"CAST({value} AS DOUBLE)", weight) for name, value, weight in parts]
    columns = ", ".join(f"{value} AS feat_{name}" for name, value, _ in double)
    total = " + ".join(feature(weight, value) for _, value, weight in double)
    return f"SELECT customer_id, dim_crm_customer_key, {columns}, {total} AS composite_score FROM {source}"


TABLES["narrow_windows"] = f"""
    SELECT d.customer_id, d.dim_crm_customer_key, s.lifetime_value, r.conversion_count, i.interaction_count
    FROM dim d
    LEFT JOIN stg_sales s ON s.customer_id = d.customer_id
    LEFT JOIN (SELECT customer_id, count(*) FILTER (WHERE event_type = 'CONVERTED') AS conversion_count
               FROM stg_events WHERE event_date >= {RUN} - 20 GROUP BY customer_id) r
           ON r.customer_id = d.customer_id
    LEFT JOIN (SELECT customer_id, count(*) AS interaction_count
               FROM stg_interactions WHERE interaction_date >= {RUN} - 10 GROUP BY customer_id) i
           ON i.customer_id = d.customer_id
    WHERE d.is_current = 'Y'"""
TABLES["unscored"] = """
    SELECT * FROM base b WHERE NOT EXISTS (
        SELECT 1 FROM procedural p WHERE p.segment_code = 'VIP' AND p.customer_id = b.customer_id
           AND p.segment_code = b.customer_segment)"""
TABLES["first_of_asia"] = "SELECT * FROM base WHERE region_code = 'ASIA' ORDER BY customer_id LIMIT 100"
TABLES["old_summary"] = summary(
    "procedural", "COALESCE(d.region_code, 'UNKNOWN')", "per_customer", "f.segment_code = 'VIP'"
)
TABLES["new_summary"] = summary("configured", "COALESCE(d.region_code, 'UNKNOWN')", "per_customer")

QUERIES: dict[str, str] = {
    "campaign_performance": performance("TRUE"),
    "campaign_performance_day": performance(f"CAST(event_date AS DATE) = {RUN}"),
    "campaign_performance_one": performance("campaign_id = 'CAMP07'"),
    "extract_profiles": "SELECT * FROM staged",
    "extract_profiles_vip": "SELECT * FROM staged WHERE customer_segment = 'VIP' AND region_code = 'EUROPE'",
    "extract_profiles_batch": "SELECT * FROM staged ORDER BY customer_id % 14, customer_id LIMIT 500",
    "extract_events": "SELECT * REPLACE (CAST(revenue_attributed AS DOUBLE) AS revenue_attributed) FROM stg_events",
    "extract_interactions": """
        SELECT * REPLACE (CAST(satisfaction_score AS DOUBLE) AS satisfaction_score) FROM stg_interactions""",
    "staging_summary": """
        SELECT 'ALL' AS segment, count(*) AS total_customers,
               count(*) FILTER (WHERE is_opted_in_email = 'Y') AS email_opted_in,
               count(DISTINCT region_code) AS regions FROM staged""",
    "staged_profiles_retail": "SELECT * FROM staged WHERE customer_segment = 'RETAIL'",
    "recent_spend": f"SELECT {SALES}, region_code, load_date FROM recent_sales",
    "retail_spend": f"SELECT {SALES}, region_code AS retail_region_code FROM stg_sales",
    "regional_summary_day": f"SELECT {REGIONAL} FROM regional WHERE summary_date = {RUN}",
    "regional_revenue_30d": f"""
        SELECT region_code, CAST(sum(total_revenue) AS DOUBLE) AS total_regional_revenue
        FROM regional WHERE summary_date >= {RUN} - 30 GROUP BY region_code""",
    "scd2_closed": f"SELECT {DIM} FROM closed",
    "scd2_inserted": f"SELECT {DIM} FROM inserted",
    "scd2_merge": "SELECT * FROM merged",
    "current_dimension": "SELECT * FROM merged WHERE is_current = 'Y'",
    "mark_loaded": """
        SELECT * REPLACE (CASE WHEN customer_segment = 'RETAIL' THEN 'LOADED' ELSE etl_status END AS etl_status)
        FROM staged""",
    "customer_conversion_rate": """
        SELECT * REPLACE (CAST(conversion_rate AS DOUBLE) AS conversion_rate) FROM rates""",
    "customer_interactions": """
        SELECT * REPLACE (CAST(interact_score AS DOUBLE) AS interact_score) FROM contacts""",
    "conversions_two_loads": f"""
        SELECT customer_id, count(DISTINCT event_id) AS event_count,
               count(DISTINCT event_id) FILTER (WHERE event_type = 'CONVERTED') AS conversion_count,
               CAST({rounded("count(DISTINCT event_id) FILTER (WHERE event_type = 'CONVERTED')", "count(DISTINCT event_id)", 4)}
                    AS DOUBLE) AS conversion_rate
        FROM events_of_two GROUP BY customer_id""",
    "interactions_two_loads": f"""
        SELECT customer_id, count(DISTINCT event_id) AS interaction_count,
               CAST({rounded("count(DISTINCT event_id)", "30", 4)} AS DOUBLE) AS interact_score
        FROM interactions_of_two GROUP BY customer_id""",
    "campaign_rollup": """
        SELECT * REPLACE (CAST(total_campaign_revenue AS DOUBLE) AS total_campaign_revenue)
        FROM rollup_by_customer""",
    "scores_procedural": f"SELECT * REPLACE (CAST(7 AS BIGINT) AS load_batch_id) FROM (SELECT {SCORES} FROM procedural)",
    "scores_config": f"SELECT {SCORES} FROM configured",
    "scores_config_batch": f"SELECT {SCORES} FROM ({score_rows('first_of_asia', 'configured')})",
    "scores_graph": f"SELECT {GRAPH} FROM graph",
    "scores_if_absent": f"SELECT {SCORES} FROM ({score_rows('unscored', 'configured')})",
    "insert_if_absent": f"""
        SELECT {SCORES} FROM configured c
        WHERE customer_id NOT IN (SELECT customer_id FROM procedural WHERE segment_code = 'RETAIL')""",
    "score_features_default": feature_query(
        "base",
        [
            ("clv_raw", "COALESCE(lifetime_value, 0)", "0.4"),
            ("recency_days", f"COALESCE({RUN} - last_purchase_date, 999)", "0.3"),
            ("camp_convs", "COALESCE(conversion_count, 0)", "0.15"),
            ("interactions", "COALESCE(interaction_count, 0)", "0.15"),
        ],
    ),
    "score_features": feature_query(
        "narrow_windows",
        [
            ("convs", "conversion_count", "0.25"),
            ("spend", "COALESCE(lifetime_value, 0)", "0.5"),
            ("contacts", "interaction_count * 10", "0.25"),
        ],
    ),
    "customers_without_spend": """
        SELECT * FROM staged WHERE customer_id NOT IN (SELECT customer_id FROM recent_sales)""",
    "churn_standard": f"SELECT {GRAPH} FROM graph WHERE churn_risk_score <= 0.70",
    "churn_at_risk": f"SELECT {GRAPH} FROM graph WHERE churn_risk_score > 0.70",
    "graph_facts": f"""
        SELECT g.customer_id, d.dim_crm_customer_key, {RUN} AS score_date, CAST(g.clv_score AS DOUBLE) AS clv_score,
               CAST(g.churn_risk_score AS DOUBLE) AS churn_risk_score, CAST(NULL AS DOUBLE) AS propensity_buy_score,
               CAST(g.engagement_score AS DOUBLE) AS engagement_score, g.customer_segment AS segment_code,
               g.segment_label, {RUN} AS batch_run_date, 'graph' AS model_version, CAST(9 AS BIGINT) AS load_batch_id
        FROM graph g LEFT JOIN dim d ON d.customer_id = g.customer_id AND d.is_current = 'Y'""",
    "segment_summary_replace": f"SELECT {SUMMARY} FROM ({summary('procedural', 'd.region_code', 'per_customer')})",
    "segment_summary_once": f"SELECT {SUMMARY} FROM ({summary('procedural', 'd.region_code', 'once')})",
    "segment_summary_named": f"SELECT {SUMMARY} FROM new_summary WHERE segment_code = 'RETAIL'",
    "segment_summary_upsert": f"""
        SELECT {SUMMARY}, {RUN} AS load_date FROM new_summary
        UNION ALL
        SELECT {SUMMARY}, {RUN} - 1 AS load_date
        FROM (SELECT * REPLACE ({RUN} - 7 AS summary_date) FROM old_summary)
        UNION ALL
        SELECT {SUMMARY}, {RUN} - 1 AS load_date FROM old_summary o
        WHERE NOT EXISTS (SELECT 1 FROM new_summary n
                          WHERE n.segment_code = o.segment_code AND n.region_code = o.region_code)""",
    "segment_rollup": f"""
        SELECT customer_segment AS segment_code, region_code, {RUN} AS summary_date, count(*) AS customer_count,
               {average('clv_score')} AS avg_clv_score, {average('churn_risk_score')} AS avg_churn_risk,
               count(*) FILTER (WHERE clv_score > 5) AS high_value_count,
               count(*) FILTER (WHERE churn_risk_score > 0.7) AS at_risk_count,
               count(*) FILTER (WHERE is_opted_in_email = 'Y') AS opted_in_email_count,
               CAST(sum(lifetime_value) AS DOUBLE) AS total_retail_spend
        FROM graph GROUP BY customer_segment, region_code""",
    "replace_slice": f"""
        SELECT {SCORES} FROM procedural WHERE segment_code <> 'VIP'
        UNION ALL SELECT {SCORES} FROM configured WHERE segment_code = 'VIP'""",
    "score_row_count": "SELECT count(*) AS row_count FROM procedural WHERE segment_code = 'VIP'",
    "staged_row_count": "SELECT count(*) AS row_count FROM staged WHERE customer_segment = 'WHOLESALE'",
    "current_scores": """
        SELECT f.customer_id, f.dim_crm_customer_key, CAST(f.clv_score AS DOUBLE) AS clv_score,
               CAST(f.churn_risk_score AS DOUBLE) AS churn_risk_score,
               CAST(f.propensity_buy_score AS DOUBLE) AS propensity_buy_score,
               CAST(f.engagement_score AS DOUBLE) AS engagement_score, f.segment_code, f.segment_label,
               d.region_code, d.acquisition_channel, d.is_opted_in_email
        FROM configured f JOIN dim d ON d.customer_id = f.customer_id AND d.is_current = 'Y'""",
    "segmented_customers": """
        SELECT * REPLACE (CAST(clv_score AS DOUBLE) AS clv_score, CAST(churn_risk_score AS DOUBLE) AS churn_risk_score,
               CAST(propensity_buy_score AS DOUBLE) AS propensity_buy_score,
               CAST(engagement_score AS DOUBLE) AS engagement_score, CAST(lifetime_value AS DOUBLE) AS lifetime_value,
               CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(avg_basket_size AS DOUBLE) AS avg_basket_size,
               CAST(composite_score AS DOUBLE) AS composite_score)
        FROM segmented""",
    "micro_segments": f"SELECT {MICRO} FROM segmented",
    "weekly_scores": f"SELECT {MICRO} FROM merged_segmented",
    "interventions": """
        SELECT micro_segment, intervention_recommended, count(*) AS customer_count
        FROM segmented GROUP BY micro_segment, intervention_recommended""",
    "region_distribution": f"""
        SELECT region_code, micro_segment, segment_code, count(*) AS customer_count,
               {average('clv_score')} AS avg_clv, {average('churn_risk_score')} AS avg_churn_risk,
               {average('composite_score')} AS avg_composite_score,
               count(*) FILTER (WHERE is_opted_in_email = 'Y') AS email_opted_in,
               CAST(sum(COALESCE(lifetime_value, 0)) AS DOUBLE) / count(*) AS avg_retail_lifetime_value,
               CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY region_code) AS DOUBLE) * 100
                   AS pct_of_region
        FROM segmented GROUP BY region_code, micro_segment, segment_code""",
    "segment_snapshot": f"""
        SELECT segment_code, region_code, count(*) AS customer_count, {average('clv_score')} AS avg_clv_score,
               {average('churn_risk_score')} AS avg_churn_risk,
               count(*) FILTER (WHERE clv_score > 5) AS high_value_count,
               count(*) FILTER (WHERE churn_risk_score > 0.7) AS at_risk_count,
               CAST(sum(COALESCE(lifetime_value, 0)) AS DOUBLE) / count(*) AS avg_retail_spend
        FROM segmented GROUP BY segment_code, region_code""",
    "audit_fold": "SELECT * FROM audit",
    "audit_upsert": "SELECT * FROM audit",
    "prerequisite_status": """
        SELECT q.*, COALESCE(a.status, 'NOT_FOUND') AS status,
               CAST(CASE COALESCE(a.status, 'NOT_FOUND') WHEN 'SUCCESS' THEN 0 WHEN 'COMPLETED' THEN 0
                    WHEN 'RUNNING' THEN 2 WHEN 'NOT_FOUND' THEN 3 ELSE 1 END AS INTEGER) AS return_code
        FROM asked q LEFT JOIN audit a USING (workflow_name, job_name, run_date)""",
    "sla_breaches": """
        SELECT workflow_name, job_name, run_date, status,
               (epoch_us(updated_date) - epoch_us(created_date)) // 1000000 AS elapsed_seconds
        FROM audit WHERE epoch_us(updated_date) - epoch_us(created_date) > 300 * 60 * CAST(1000000 AS BIGINT)""",
    "execution_log": f"SELECT * FROM audit WHERE run_date = {RUN} ORDER BY created_date, workflow_name, job_name",
    "dependencies_narrow": f"""
        SELECT object_name, table_ref, count(*) AS edge_count FROM edges
        WHERE object_owner IN {THREE} GROUP BY object_name, table_ref""",
    "dependency_map": "SELECT * FROM mapped",
    "dependency_lists": """
        SELECT object_name, page, array_to_string(table_refs, ',') AS table_refs,
               array_to_string(edge_counts, ',') AS edge_counts, edge_count, table_count FROM lists""",
    "grant_links": "SELECT * FROM links",
    "chain_refs": """
        SELECT * REPLACE (array_to_string(source_tables, ',') AS source_tables,
                          array_to_string(plsql_table_refs, ',') AS plsql_table_refs) FROM chain_lists""",
    "lineage_snapshot": f"""
        SELECT 'lineage_snapshot' AS section, CAST(json_object('run_date', '2024-01-30', 'workflow', 'WEEKLY',
               'generated_at', '2024-01-30T04:00:00', 'schema_scope',
               ['CRM_SCHEMA', 'DW_OWNER', 'FINANCE_SCHEMA']) AS VARCHAR) AS document
        UNION ALL
        SELECT 'lineage_chains', CAST(json_object('chain_id', chain_id, 'uc4_workflow', uc4_workflow,
               'uc4_job', uc4_job, 'source_tables', source_tables, 'staging_table', staging_table,
               'plsql_package', plsql_package, 'target_table', target_table, 'segment_code', segment_code,
               'ksh_script', ksh_script, 'sqlplus_script', sqlplus_script, 'abinitio_graph', abinitio_graph,
               'spark_job', spark_job, 'cross_repo_source', cross_repo_source, 'page', page,
               'plsql_table_refs', plsql_table_refs, 'has_table_refs', has_table_refs) AS VARCHAR) FROM chain_lists
        UNION ALL
        SELECT 'cross_repo_links', CAST(json_object('source_repo', source_repo, 'source_schema', source_schema,
               'source_table', source_table, 'target_repo', target_repo, 'target_schema', target_schema,
               'access_type', access_type, 'link_type', link_type) AS VARCHAR) FROM links
        UNION ALL
        SELECT 'dependency_map', CAST(json_object('object_name', object_name, 'page', page,
               'table_refs', table_refs) AS VARCHAR) FROM lists
        UNION ALL
        SELECT 'etl_execution_log', CAST(json_object('workflow_name', workflow_name, 'job_name', job_name,
               'run_date', strftime(run_date, '%Y-%m-%d'), 'status', status, 'rows_processed', rows_processed,
               'created_date', strftime(created_date, '%Y-%m-%dT%H:%M:%S.%g'),
               'updated_date', strftime(updated_date, '%Y-%m-%dT%H:%M:%S.%g')) AS VARCHAR)
        FROM audit WHERE run_date = {RUN}
        UNION ALL
        SELECT 'summary', CAST(json_object('total_chains', (SELECT count(*) FROM chains),
               'cross_repo_links', (SELECT count(*) FROM links),
               'plsql_dependencies', (SELECT CAST(sum(edge_count) AS BIGINT) FROM mapped),
               'repos_involved', ['customer', 'retail', 'finance']) AS VARCHAR)""",
}


def with_tables(sql: str) -> str:
    """The query preceded by the subqueries it needs, in the order of ``TABLES``."""
    needed: set[str] = set()
    waiting = [sql]
    while waiting:
        words = set(re.findall(r"[a-z_]+", waiting.pop()))
        for name in (words & TABLES.keys()) - needed:
            needed.add(name)
            waiting.append(TABLES[name])
    if not needed:
        return sql
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for other in set(re.findall(r"[a-z_]+", TABLES[name])) & TABLES.keys():
            if other != name:
                place(other)
        order.append(name)

    for name in TABLES:
        if name in needed:
            place(name)
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name]})" for name in order) + "\n" + sql


def all_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in QUERIES.items()}

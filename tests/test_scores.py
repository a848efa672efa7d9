import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientele import schemas
from clientele.functions import fixed_values as fv
from clientele.functions import ladders
from clientele.operators import features, scoring, segments
from clientele.sources import config
from tests.helpers import RUN, by_key, frame, rows


def ago(days):
    return RUN - dt.timedelta(days=days)


@pytest.mark.parametrize(
    ("days", "risk"),
    [
        (0, "0.05"),
        (30, "0.05"),
        (31, "0.20"),
        (90, "0.20"),
        (91, "0.50"),
        (180, "0.50"),
        (181, "0.80"),
        (None, "0.95"),
    ],
)
def test_churn_steps(spark, days, risk):
    last = None if days is None else ago(days)
    df = spark.createDataFrame([(last,)], "last date")
    assert df.select(ladders.churn_risk(F.col("last"), RUN)).first()[0] == Decimal(risk)


@pytest.mark.parametrize(
    ("value", "free", "capped"),
    [
        ("0", "0", "0"),
        ("5000.00", "5", "5"),
        ("5000.01", "5.0000", "5.0000"),
        ("5000.05", "5.0001", "5.0001"),
        ("10000.00", "10", "10"),
        ("20000.00", "20", "10"),
        (None, "0", "0"),
    ],
)
def test_lifetime_value_score(spark, value, free, capped):
    df = spark.createDataFrame([(value,)], "v string").select(F.col("v").cast("decimal(14,2)").alias("v"))
    got = df.select(ladders.clv_score(F.col("v")), ladders.clv_score(F.col("v"), fv.CLV_CAP)).first()
    assert tuple(got) == (Decimal(free), Decimal(capped))


@pytest.mark.parametrize(
    ("seen", "interactions", "conversions"),
    [(0, "0", "0"), (1, ".25", ".25"), (2, ".25", ".5"), (5, ".25", ".5"), (6, ".75", ".75"), (10, ".75", ".75"),
     (11, "1", "1")],
)
def test_engagement_steps(spark, seen, interactions, conversions):
    got = spark.range(1).select(
        ladders.above(F.lit(seen), fv.INTERACTION_STEPS, "0.0"),
        ladders.above(F.lit(seen), fv.CONVERSION_STEPS, "0.0"),
    )
    assert tuple(got.first()) == (Decimal(interactions), Decimal(conversions))


@pytest.mark.parametrize(("part", "whole", "result"), [(1, 3, "0.3333"), (1, 32, "0.0313"), (0, 5, "0"), (3, 0, None)])
def test_ratio(spark, part, whole, result):
    got = spark.range(1).select(ladders.ratio(F.lit(part), F.lit(whole), 4)).first()[0]
    assert got == (None if result is None else Decimal(result))


def inputs(spark, customers, sales=(), events=(), interactions=()):
    """Dimension rows, retail rows, staged events and staged interactions."""
    return (
        frame(spark, schemas.DIM_CUSTOMER_CRM, *customers, is_current="Y", customer_segment="VIP"),
        frame(spark, schemas.STG_CUSTOMER_SALES, *sales, load_date=RUN),
        frame(spark, schemas.STG_CAMPAIGN_EVENTS, *events, load_date=RUN, revenue_attributed=0),
        frame(spark, schemas.STG_CUSTOMER_INTERACTIONS, *interactions, load_date=RUN),
    )


def at(days, hour=0):
    return dt.datetime.combine(ago(days), dt.time(hour))


def test_procedural_and_configured_scores(spark):
    tables = inputs(
        spark,
        [{"customer_id": 1}, {"customer_id": 2, "customer_segment": "OTHER"}, {"customer_id": 3, "is_current": "N"}],
        [{"customer_id": 1, "lifetime_value": 12345.67, "last_purchase_date": ago(100)}],
        [
            {"customer_id": 1, "event_type": "CONVERTED", "event_date": at(90)},
            {"customer_id": 1, "event_type": "SENT", "event_date": at(0, 23)},
            {"customer_id": 1, "event_type": "SENT", "event_date": at(1)},
            {"customer_id": 1, "event_type": "CONVERTED", "event_date": at(91, 23)},
        ],
        [{"customer_id": 1, "interaction_date": at(30)}, {"customer_id": 1, "interaction_date": at(31, 23)}],
    )
    columns = ("clv_score", "churn_risk_score", "propensity_buy_score", "engagement_score", "segment_label")
    procedural = by_key(scoring.scores_procedural(*tables, RUN), "customer_id", *columns)
    assert procedural == {
        1: (Decimal("12.3457"), Decimal("0.5"), Decimal("0.3333"), Decimal("0.0333"), "High-Value Premium"),
        2: (0, Decimal("0.95"), 0, 0, "Unclassified"),
    }
    configured = by_key(scoring.scores_config(*tables, RUN), "customer_id", *columns)
    assert configured[1] == (10, Decimal("0.5"), Decimal("0.3333"), Decimal("0.25"), "High-Value Premium Customer")


def test_repeated_staging_counts_once_and_older_loads_still_count(spark):
    week = dt.timedelta(days=7)
    twice = [
        {"customer_id": 1, "event_type": kind, "event_date": at(20), "load_date": load}
        for kind in ("CONVERTED", "SENT")
        for load in (RUN - week, RUN)
    ]
    once = [
        {"customer_id": 1, "event_type": "SENT", "event_date": at(1), "load_date": RUN},
        {"customer_id": 2, "event_type": "CONVERTED", "event_date": at(20), "load_date": RUN - week},
    ]
    events = frame(spark, schemas.STG_CAMPAIGN_EVENTS, *twice, *once)
    rates = by_key(scoring.conversion_rates(events, RUN), "customer_id", "event_count", "conversion_rate")
    assert rates == {1: (3, Decimal("0.3333")), 2: (1, Decimal(1))}
    seen = [
        {"customer_id": c, "interaction_date": at(9), "load_date": load}
        for c, load in ((1, RUN - week), (1, RUN), (2, RUN - week))
    ]
    counts = scoring.interaction_counts(frame(spark, schemas.STG_CUSTOMER_INTERACTIONS, *seen), RUN)
    assert by_key(counts, "customer_id", "interaction_count") == {1: 1, 2: 1}


def test_a_window_wider_than_a_load_counts_the_older_load(spark):
    events = frame(
        spark,
        schemas.STG_CAMPAIGN_EVENTS,
        {"event_type": "CONVERTED", "event_date": at(102), "load_date": RUN - dt.timedelta(days=70)},
        {"event_type": "SENT", "event_date": at(60), "load_date": RUN - dt.timedelta(days=7)},
        {"event_type": "SENT", "event_date": at(60), "load_date": RUN},
        customer_id=1,
    )
    rates = scoring.conversion_rates(events, RUN, days=180)
    assert rows(rates, "event_count", "conversion_count", "conversion_rate") == [(2, 1, Decimal("0.5"))]
    seen = frame(
        spark,
        schemas.STG_CUSTOMER_INTERACTIONS,
        {"interaction_date": at(50), "load_date": RUN - dt.timedelta(days=40)},
        {"interaction_date": at(9), "load_date": RUN},
        customer_id=1,
    )
    assert rows(scoring.interaction_counts(seen, RUN, days=60), "interaction_count") == [(2,)]


def test_three_hundred_interactions_do_not_overflow(spark):
    many = [{"customer_id": 1, "interaction_date": at(1)}] * 300
    tables = inputs(spark, [{"customer_id": 1}], interactions=many)
    assert scoring.scores_procedural(*tables, RUN).first().engagement_score == 10


def test_recency_is_counted_from_as_of(spark):
    tables = inputs(spark, [{"customer_id": 1}], [{"customer_id": 1, "last_purchase_date": ago(0)}])
    later = scoring.scores_procedural(*tables, RUN, as_of=RUN + dt.timedelta(days=181))
    assert later.first().churn_risk_score == Decimal("0.8")


def test_latest_retail_row_wins(spark):
    sales = [
        {"customer_id": 1, "lifetime_value": 9000, "load_date": ago(7)},
        {"customer_id": 1, "lifetime_value": 1000, "load_date": ago(1)},
    ]
    tables = inputs(spark, [{"customer_id": 1}], sales)
    assert rows(scoring.scores_procedural(*tables, RUN), "customer_id", "clv_score") == [(1, Decimal(1))]


def test_batch_takes_lowest_unscored_ids(spark):
    tables = inputs(spark, [{"customer_id": i} for i in range(1, 6)])
    done = scoring.scores_procedural(*inputs(spark, [{"customer_id": 1}, {"customer_id": 3}]), RUN)
    fresh = scoring.scores_config(*tables, RUN, batch_size=2, already=done)
    assert rows(fresh, "customer_id") == [(2,), (4,)]
    assert scoring.scores_config(*tables, RUN, already=done, model_version="v9").count() == 5


def test_graph_scores_and_split(spark):
    staged = frame(
        spark,
        schemas.STG_CUSTOMER_PROFILE,
        {"customer_id": 1, "first_name": "A", "last_name": "B"},
        {"customer_id": 2, "first_name": "A"},
        customer_segment="RETAIL",
    )
    spend = frame(
        spark, schemas.STG_CUSTOMER_SALES, {"customer_id": 1, "lifetime_value": 10, "last_purchase_date": ago(5)}
    )
    events = frame(
        spark, schemas.STG_CAMPAIGN_EVENTS, {"customer_id": 1, "event_type": "CONVERTED", "revenue_attributed": 2.5}
    )
    scored = scoring.scores_graph(scoring.enrich_profiles(staged, spend, events), RUN)
    got = by_key(
        scored, "customer_id", "full_name", "loyalty_tier", "days_since_purchase", "campaign_conversions",
        "total_campaign_revenue", "engagement_score",
    )
    assert got[1] == ("A B", "STANDARD", 5, 1, Decimal("2.5"), Decimal("0.25"))
    assert got[2] == ("A ", "STANDARD", 999, 0, 0, 0)
    standard, at_risk = scoring.churn_split(scored)
    assert rows(standard, "customer_id") == [(1,)]
    assert rows(at_risk, "customer_id") == [(2,)]
    assert rows(scoring.customers_without_spend(staged, spend), "customer_id") == [(2,)]


def test_split_is_inclusive_at_the_limit(spark):
    df = spark.createDataFrame([(Decimal("0.7000"),), (Decimal("0.7001"),)], "churn_risk_score decimal(5,4)")
    standard, at_risk = scoring.churn_split(df)
    assert (rows(standard), rows(at_risk)) == ([(Decimal("0.7000"),)], [(Decimal("0.7001"),)])


CONFIG = schemas.SCORING_FEATURE_CONFIG


def test_feature_choice_and_windows(spark):
    table = frame(
        spark,
        CONFIG,
        {"feature_name": "b", "execution_order": 2, "source_table": "STG_CAMPAIGN_EVENTS", "aggregation_window_days": 9},
        {"feature_name": "a", "execution_order": 1, "target_segment": "VIP", "aggregation_window_days": 99},
        {"feature_name": "off", "is_active": "N"},
        {"feature_name": "other", "target_segment": "RETAIL"},
        {"feature_name": "old", "model_version": "v1"},
        sql_expression="1",
        feature_weight=1.0,
        model_version="v2",
        target_segment="ALL",
        is_active="Y",
    )
    chosen = config.load_features(table, "v2", "VIP")
    assert [f.name for f in chosen] == ["a", "b"]
    assert config.campaign_window(chosen) == 9
    assert config.interaction_window(chosen) == 30
    assert config.campaign_window([]) == 90
    assert config.campaign_window(config.DEFAULT_FEATURES) == 90


def test_default_features(spark):
    tables = inputs(
        spark,
        [{"customer_id": 1}, {"customer_id": 2}],
        [{"customer_id": 1, "lifetime_value": 500, "last_purchase_date": ago(10)}],
    )
    base = features.feature_input(*tables, RUN, config.DEFAULT_FEATURES)
    got = by_key(features.score_features(base, []), "customer_id", "feat_clv_raw", "feat_recency_days", "composite_score")
    assert got[1] == (500.0, 10.0, pytest.approx(0.4 * 0.5 + 0.3 * 0.01))
    assert got[2] == (0.0, 999.0, pytest.approx(0.3 * 0.999))


def test_null_feature_counts_as_zero_and_unknown_column_fails(spark):
    tables = inputs(spark, [{"customer_id": 1}])
    base = features.feature_input(*tables, RUN, [])
    only_null = [config.Feature("x", "lifetime_value", 1.0), config.Feature("big", "5000", 0.5)]
    assert features.score_features(base, only_null).first().composite_score == 0.5
    with pytest.raises(Exception, match="no_such_column"):
        features.score_features(base, [config.Feature("x", "no_such_column", 1.0)])


def test_score_source(spark):
    assert config.score_source(spark, "no-such") == "V_SCORE_INPUTS_GENERIC"
    spark.range(1).createOrReplaceTempView("score_input_top_tier")
    assert config.score_source(spark, "top-tier") == "SCORE_INPUT_TOP_TIER"
    spark.catalog.dropTempView("score_input_top_tier")


def classified(spark, *cases):
    schema = (
        "id int, clv_score decimal(12,4), churn_risk_score decimal(5,4), engagement_score decimal(9,4), "
        "propensity_buy_score decimal(5,4), lifetime_value decimal(14,2), is_opted_in_email string"
    )
    made = [
        (i, *[None if v is None else Decimal(v) for v in case[:5]], case[5]) for i, case in enumerate(cases)
    ]
    return segments.classify(spark.createDataFrame(made, schema))


@pytest.mark.parametrize(
    ("composite", "name"),
    [(".8", "CHAMPION"), (".79999999", "LOYAL_CUSTOMER"), (".6", "LOYAL_CUSTOMER"), (".4", "POTENTIAL_LOYALIST"),
     (".2", "AT_RISK"), (".19999999", "LOST_CUSTOMER"), (None, "LOST_CUSTOMER")],
)
def test_micro_segment_limits(spark, composite, name):
    df = spark.createDataFrame([(None if composite is None else Decimal(composite),)], "c decimal(22,8)")
    assert df.select(segments.micro_segment(F.col("c"))).first()[0] == name


def test_interventions_and_composite(spark):
    df = classified(
        spark,
        ("2", "0.8", "0", "0", "0", "N"),  # churn high, composite .65
        ("0", "0.8", "0", "0", "0", "N"),  # churn high, composite .05, engagement low
        ("8", "0.05", "1", "0", "0", "Y"),
        ("8", "0.05", "1", "0", "0", None),
        ("7", "0.05", "1", "0", "0", "Y"),
        ("0", "0.5", "0", "0", "20000", "Y"),
        (None, "0.8", "0", "0", "0", "Y"),
        ("8", "0.05", "1", None, "0", "Y"),
    )
    got = by_key(df, "id", "composite_score", "micro_segment", "intervention_recommended")
    assert got[0] == (Decimal("0.65"), "LOYAL_CUSTOMER", "WINBACK_CAMPAIGN")
    assert got[1] == (Decimal("0.05"), "LOST_CUSTOMER", "REENGAGEMENT_CAMPAIGN")
    assert got[2][2] == "VIP_UPGRADE"
    assert got[3][2] == got[4][2] == "NO_ACTION"
    assert got[5][0] == Decimal("0.225")
    assert got[6] == (None, "LOST_CUSTOMER", "REENGAGEMENT_CAMPAIGN")
    assert got[7] == (None, "LOST_CUSTOMER", "VIP_UPGRADE")


def test_shares_of_a_region_add_up(spark):
    from tests.conftest import SMALL
    from verification.queries import Inputs

    shares = segments.region_distribution(Inputs(spark, SMALL).segmented())
    totals = shares.groupBy("region_code").agg(F.sum("pct_of_region").alias("total")).collect()
    assert any(r.region_code is None for r in totals)
    assert all(r.total == pytest.approx(100) for r in totals)

"""Table reads (files or JDBC) and the filtered reads the jobs start from."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clientele.functions import fixed_values as fv
from clientele.functions.predicates import only, since_days
from clientele.functions.selection import days_key, days_of, newest_rows

JDBC_FETCH_SIZE = 10000


@dataclasses.dataclass(frozen=True)
class JdbcSplit:
    """How a JDBC read is divided over tasks."""

    column: str
    lower: int
    upper: int
    partitions: int


def read_jdbc(
    spark: SparkSession,
    url: str,
    source: str,
    split: JdbcSplit,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table name, or a bracketed subquery with an alias, read over JDBC."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=source, fetchsize=str(JDBC_FETCH_SIZE))
    reader = reader.options(
        partitionColumn=split.column,
        lowerBound=str(split.lower),
        upperBound=str(split.upper),
        numPartitions=str(split.partitions),
    )
    return reader.options(**(options or {})).load()


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A file table; filters and column choice made later reach the scan."""
    reader = spark.read.format(file_format).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table, or no rows where nothing has been written to the path yet."""
    try:
        found = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return found.select(*schema.names)


def current_scores(
    scores: DataFrame, dimension: DataFrame, run_date: dt.date, model_version: str | None = None
) -> DataFrame:
    """Scores of one date with region, channel and opt-in of the current dimension row."""
    of_date = scores.filter(F.col("score_date") == F.lit(run_date))
    of_date = only(of_date, "model_version", model_version).select(
        "customer_id",
        "dim_crm_customer_key",
        "clv_score",
        "churn_risk_score",
        "propensity_buy_score",
        "engagement_score",
        "segment_code",
        "segment_label",
    )
    current = dimension.filter(F.col("is_current") == "Y").select(
        "customer_id", "region_code", "acquisition_channel", "is_opted_in_email"
    )
    return of_date.join(current, "customer_id", "inner")


def retail_spend(sales: DataFrame) -> DataFrame:
    """Retail rows, one per customer: the latest load wins."""
    return latest_sales(sales, SALES_ORDER[1:]).select(
        "customer_id",
        "lifetime_value",
        "loyalty_tier",
        "last_purchase_date",
        F.col("region_code").alias("retail_region_code"),
    )


SALES_ORDER = ["load_date", "last_purchase_date", "lifetime_value", "loyalty_tier", "region_code"]


def latest_sales(sales: DataFrame, columns: Sequence[str] = SALES_ORDER) -> DataFrame:
    """One retail row per customer, so that a join on the customer never multiplies rows.

    The latest load wins, then the later purchase, and so on along ``SALES_ORDER``; asking for the leading columns
    only gives the same values and reads less. Both dates are compared as one number, and dates and values are found by hash
    aggregation; where texts are asked for, they are fetched for the newest rows.
    """
    days = days_key(F.col("load_date"), F.col("last_purchase_date"))
    if max(SALES_ORDER.index(c) for c in columns) <= SALES_ORDER.index("lifetime_value"):
        by_days = sales.groupBy("customer_id", days.alias("days")).agg(F.max("lifetime_value").alias("value"))
        newest = by_days.groupBy("customer_id").agg(
            F.max("days").alias("days"), F.max_by("value", "days").alias("lifetime_value")
        )
        load, purchase = days_of(F.col("days"))
        found = newest.withColumns({"load_date": load, "last_purchase_date": purchase})
    else:
        found = newest_rows(sales, ["customer_id"], days, SALES_ORDER[2:])
    return found.select("customer_id", *columns)


def recent_spend(sales: DataFrame, run_date: dt.date, days: int = fv.SPEND_DAYS) -> DataFrame:
    """Retail rows loaded since ``days`` before the run."""
    return sales.filter(since_days("load_date", run_date, days))


def regional_summary(regional: DataFrame, run_date: dt.date) -> DataFrame:
    """Regional rows of one date."""
    return regional.filter(F.col("summary_date") == F.lit(run_date)).select(
        "region_code", "summary_date", "total_revenue", "distinct_customers", "avg_basket_size"
    )


def regional_revenue(regional: DataFrame, run_date: dt.date, days: int = fv.REGIONAL_DAYS) -> DataFrame:
    """Revenue by region since ``days`` before the run."""
    return (
        regional.filter(since_days("summary_date", run_date, days))
        .groupBy("region_code")
        .agg(F.sum("total_revenue").alias("total_regional_revenue"))
    )


def staged_profiles(
    profiles: DataFrame,
    run_date: dt.date,
    segment: str = "ALL",
    region: str = "ALL",
    status: str | None = fv.PENDING,
) -> DataFrame:
    """Staged profiles of a date, segment, region and status (None: any status)."""
    of_date = profiles.filter(F.col("load_date") == F.lit(run_date))
    of_date = only(of_date, "customer_segment", segment)
    of_date = only(of_date, "region_code", region)
    return only(of_date, "etl_status", status)


def staged_events(events: DataFrame, run_date: dt.date) -> DataFrame:
    """Campaign events staged by one run."""
    return events.filter(F.col("load_date") == F.lit(run_date))

"""Job audit: status table from messages, prerequisite checks, late jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv
from clientele.functions.selection import newest_rows
from clientele.sinks.merge import upsert

AUDIT_KEY = ["workflow_name", "job_name", "run_date"]


def fold_messages(messages: DataFrame) -> DataFrame:
    """One audit row per job and run date.

    The first message creates the row; later ones set status, row count and update time, so a job with a single
    message has no update time.
    """
    last = newest_rows(
        messages,
        AUDIT_KEY,
        F.col("message_ts"),
        ["rows_processed", "status"],
        created_date=F.min("message_ts"),
        message_count=F.count(F.lit(1)),
    )
    return last.select(
        *AUDIT_KEY,
        "status",
        "rows_processed",
        "created_date",
        F.when(F.col("message_count") > 1, F.col("message_ts")).alias("updated_date"),
        F.col("message_ts").alias("last_message"),
    )


def audit_upsert(audit: DataFrame, messages: DataFrame) -> DataFrame:
    """The audit table after a batch of messages.

    A job already in the table keeps its creation time and takes the rest from the newest message, even where the
    batch holds only one for it.
    """
    changes = fold_messages(messages).withColumnsRenamed(
        {"updated_date": "first_update", "last_message": "updated_date"}
    )
    return upsert(
        audit,
        changes,
        AUDIT_KEY,
        update=["status", "rows_processed", "updated_date"],
        insert={"updated_date": F.col("new.first_update")},
    )


def prerequisite_status(audit: DataFrame, asked: DataFrame) -> DataFrame:
    """Status and return code of each asked workflow, job and date; NOT_FOUND where the audit has none."""
    known = audit.groupBy(*AUDIT_KEY).agg(F.max("status").alias("status"))
    answered = asked.join(known, AUDIT_KEY, "left").withColumn(
        "status", F.coalesce("status", F.lit(fv.NOT_FOUND))
    )
    code = reduce(
        lambda chain, item: chain.when(F.col("status") == item[0], item[1]),
        list(fv.STATUS_CODES.items())[1:],
        F.when(F.col("status") == "SUCCESS", fv.STATUS_CODES["SUCCESS"]),
    )
    return answered.withColumn("return_code", code.otherwise(fv.OTHER_STATUS_CODE))


def sla_breaches(audit: DataFrame, minutes: int = fv.SLA_MINUTES) -> DataFrame:
    """Jobs whose last update came more than ``minutes`` after their creation, with the seconds taken."""
    limit = F.make_dt_interval(mins=F.lit(minutes))
    taken = F.col("updated_date") - F.col("created_date")
    return audit.filter(F.col("updated_date") > F.col("created_date") + limit).select(
        *AUDIT_KEY,
        "status",
        taken.cast("interval second").cast("bigint").alias("elapsed_seconds"),
    )

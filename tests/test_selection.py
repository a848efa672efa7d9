"""The newest row of each key and the first rows of a table against plain sorting."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientele.functions.selection import days_key, days_of, first_rows, newest_days_rows, newest_rows
from clientele.sources.tables import SALES_ORDER, latest_sales
from tests.helpers import RUN, rows


def day(n):
    return None if n is None else RUN + dt.timedelta(days=n)


def test_two_days_as_one_number(spark):
    days = [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), RUN, dt.date(9999, 12, 31)]
    given = spark.createDataFrame([(a, b) for a in days for b in days], "a date, b date")
    key = given.withColumn("key", days_key(F.col("a"), F.col("b")))
    first, second = days_of(F.col("key"))
    assert key.filter(~first.eqNullSafe(F.col("a")) | ~second.eqNullSafe(F.col("b"))).count() == 0
    ordered = [tuple(r) for r in key.orderBy("key").select("a", "b").collect()]
    assert ordered == [(a, b) for a in days for b in days]


@pytest.mark.parametrize("width", [1, 2, 3, 4, 5])
def test_latest_sales(spark, width):
    """Ties at every column, and nulls in each."""
    random.seed(width)
    some = lambda *values: random.choice([None, *values])
    given = [
        (random.randrange(40), day(some(0, -1)), day(some(-3, -4)), some(Decimal(1), Decimal(2)), some("A", "B"), some("R", "S"))
        for _ in range(600)
    ] + [(99, None, None, None, None, None)]
    schema = "customer_id bigint, load_date date, last_purchase_date date, lifetime_value decimal(14,2), loyalty_tier string, region_code string"
    table = spark.createDataFrame(given, schema).repartition(5)

    def order(row):
        return [(x is not None, x if x is not None else 0) for x in row[1:]]

    best = {}
    for row in given:
        if row[0] not in best or order(row) > order(best[row[0]]):
            best[row[0]] = row
    found = latest_sales(table, SALES_ORDER[:width]).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((r[: width + 1] for r in best.values()), key=repr)


def test_newest_rows_with_null_keys_and_figures(spark):
    given = spark.createDataFrame(
        [(None, 1, "a"), (None, 2, "b"), (1, 5, "x"), (1, 5, "y"), (2, None, "z")], "k int, n int, t string"
    )
    found = newest_rows(given, ["k"], F.col("n"), ["t"], held=F.count(F.lit(1)))
    assert found.columns == ["k", "n", "t", "held"]
    assert rows(found) == [(1, 5, "y", 2), (2, None, "z", 1), (None, 2, "b", 2)]


def test_first_rows(spark):
    keys = random.Random(2).sample(range(-(10**12), 10**12), 500) + [0, 1, 2, 3]
    given = spark.createDataFrame([(k, str(k)) for k in keys], "k bigint, t string").repartition(6)
    for n in (0, 1, 77, 504, 1000):
        assert sorted(r.k for r in first_rows(given, n, "k").collect()) == sorted(keys)[:n]
    assert first_rows(given.limit(0), 3, "k").count() == 0


def test_newest_days_rows(spark):
    picked = random.Random(3)
    given = [(k, day(-picked.randrange(5))) for k in picked.sample(range(10**6), 300)]
    table = spark.createDataFrame(given, "k bigint, day date").repartition(6)
    order = sorted(given, key=lambda r: (-r[1].toordinal(), r[0]))
    for n in (0, 1, 50, 120, 299, 300, 900):
        assert sorted(map(tuple, newest_days_rows(table, n, "day", "k").collect())) == sorted((d, k) for k, d in order[:n])

"""Small frames written by hand: only the columns a test is about, the rest null."""

import datetime as dt
from decimal import Decimal

from pyspark.sql.types import DecimalType

RUN = dt.date(2024, 1, 30)


def frame(spark, schema, *rows, **defaults):
    def value(field, row):
        given = {**defaults, **row}.get(field.name)
        if isinstance(field.dataType, DecimalType) and given is not None:
            return Decimal(str(given))
        return given

    return spark.createDataFrame([tuple(value(f, row) for f in schema.fields) for row in rows], schema)


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def by_key(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}

"""Order-insensitive comparison of a Spark result with a DuckDB result, columns by name."""

import datetime as dt
import math


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def spark_table(df):
    return table_of(df.columns, df.collect())


def duck_table(connection, sql):
    result = connection.execute(sql)
    return table_of([c[0] for c in result.description], result.fetchall())

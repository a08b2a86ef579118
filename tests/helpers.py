"""Small helpers shared by the tests."""

import math

TESTDATA = "/root/testdata"


def rows(df):
    """Rows of a DataFrame as a set-like sorted list of dicts."""
    return [r.asDict() for r in df.collect()]


def by(df, key):
    """Rows of a DataFrame by the value of one column."""
    return {r[key]: r.asDict() for r in df.collect()}


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return f"{type(value).__name__}:{value!r}"


def canonical(columns, data):
    """Columns by name and rows in a fixed order, with exact values and types."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in data)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duckdb_result(connection, sql):
    cursor = connection.execute(sql)
    return canonical([c[0] for c in cursor.description], cursor.fetchall())


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()

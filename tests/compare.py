"""Rows of a Spark result and of SQL, in a common order."""


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(map(repr, map(tuple, df.select(*(f"`{c}`" for c in cols)).collect())))


def sql_rows(duck, sql):
    r = duck.sql(sql)
    cols = sorted(r.columns)
    at = [r.columns.index(c) for c in cols]
    return cols, sorted(repr(tuple(x[i] for i in at)) for x in r.fetchall())
